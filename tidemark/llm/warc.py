"""WARC archives: one gzip member per record, written and read in the tasks."""

from __future__ import annotations

import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.skew import salted_join
from tidemark.plans.storage import settle

#: Smaller payloads are always written out.
REVISIT_BYTES = 100
#: An archive is closed when it has grown to this size.
ARCHIVE_BYTES = 64 << 20
READ_BYTES = 1 << 20

# The format's line end, version line and media types.
EOL = b"\r\n"
VERSION = "WARC/1.1"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
RESPONSE_TYPE = "application/http; msgtype=response"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_store(folder: str):
    """File system and plain path of a folder that driver and executors share."""
    from pyarrow import fs

    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = folder.replace("file:", "file://", 1)
    if "://" in folder:
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


def _head(fields: list[tuple[str, object]]) -> bytes:
    lines = [VERSION, *(f"{name}: {value}" for name, value in fields)]
    return "\r\n".join(lines).encode() + EOL + EOL


def _member(head: bytes, block: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head) + packer.compress(block) + packer.compress(EOL + EOL) + packer.flush()


def _page_name(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id, url, payload: bytes, digest: str, first, date: str) -> bytes:
    """A page as one gzip member; ``first`` is the page it repeats, or null."""
    uri = "".join((url or "").split()) or f"urn:page:{page_id}"
    common = [
        ("WARC-Record-ID", _page_name(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
    ]
    if first is not None:
        fields = [
            ("WARC-Type", "revisit"),
            *common,
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", _page_name(first)),
            ("X-Payload-Length", len(payload)),
            ("Content-Length", 0),
        ]
        return _member(_head(fields), b"")
    block = HTTP_HEAD.format(len(payload)).encode() + payload
    fields = [
        ("WARC-Type", "response"),
        *common,
        ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()),
        ("Content-Type", RESPONSE_TYPE),
        ("Content-Length", len(block)),
    ]
    return _member(_head(fields), block)


def with_first_copy(
    pages: DataFrame, page: str = "page_id", url: str = "url", payload: str = "html"
) -> DataFrame:
    """Pages with their payload's bytes, digest and the smallest page of equal payload.

    ``first`` is null where nothing is to be revisited. Only digests that occur
    under several ids are kept for the join; they are written out first, so that
    they are broadcast only if their true size allows it.
    """
    body = F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8")
    plain = pages.select(
        F.col(page).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        body.alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    repeated = (
        plain.where(F.octet_length("payload") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("least"), F.max("page_id").alias("most"), F.count("*").alias("n"))
        .where("n > 1 AND least IS NOT NULL")
        .select("digest", "least")
    )
    joined = plain.join(settle(repeated, "repeated-payloads"), "digest", "left")
    first = F.when(~F.col("page_id").eqNullSafe(F.col("least")), F.col("least"))
    return joined.select("page_id", "url", "payload", "digest", first.alias("first"))


def write_archives(
    pages: DataFrame,
    folder: str,
    page: str = "page_id",
    url: str = "url",
    payload: str = "html",
    date: str = "2024-01-01T00:00:00Z",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write one WARC record per page into ``folder``; gives the archives written.

    ``folder`` must be reachable by all executors. Of pages whose payloads are
    equal and at least 100 bytes long, the one with the smallest id becomes the
    response and the others revisit it. The returned table (``path``, ``bytes``,
    ``records``) names the files of the attempts that counted; files of lost or
    repeated attempts are not in it.

    Null payloads are empty. A null id never becomes the one revisited, unless no
    copy has an id: then all are responses. Rows that repeat the smallest id are
    responses too. Null urls are replaced by the page's name. An empty table
    gives no archive.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, plain = open_store(folder)
        store.create_dir(plain, recursive=True)
        task = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        done, out, size, records = [], None, 0, 0

        def close():
            out.close()
            done.append((name, size, records))

        for batch in batches:
            for row in zip(*(column for column in batch.columns)):
                if out is None:
                    name = f"part-{task}-{len(done):05d}.warc.gz"
                    out, size, records = store.open_output_stream(posixpath.join(plain, name), compression=None), 0, 0
                page_id, uri, body, digest, first = (value.as_py() for value in row)
                size += out.write(record(page_id, uri, body, digest, first, date))
                records += 1
                if size >= archive_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([posixpath.join(folder, n) for n, _, _ in done], pa.string()),
                pa.array([s for _, s, _ in done], pa.int64()),
                pa.array([r for _, _, r in done], pa.int64()),
            ],
            names=["path", "bytes", "records"],
        )

    named = with_first_copy(pages, page, url, payload)
    written = named.mapInArrow(write, "path string, bytes long, records long")
    return settle(written, "archives")


def members(stream) -> Iterator[Iterator[bytes]]:
    """The gzip members of a stream, each as chunks of plain bytes to be read in order."""
    rest = stream.read(READ_BYTES)

    def chunks(unpacker) -> Iterator[bytes]:
        nonlocal rest
        data = rest
        while True:
            plain = unpacker.decompress(data, READ_BYTES)
            if plain:
                yield plain
            if unpacker.eof:
                rest = unpacker.unused_data or stream.read(READ_BYTES)
                return
            data = unpacker.unconsumed_tail
            if not data and len(plain) < READ_BYTES:
                data = stream.read(READ_BYTES)
                if not data:
                    raise ValueError("archive ends inside a record")

    while rest:
        yield chunks(zlib.decompressobj(31))


class Framed:
    """A record's bytes taken by fields and by length."""

    def __init__(self, chunks: Iterator[bytes]):
        self.chunks, self.buffer = chunks, b""

    def fields(self) -> tuple[str, dict[str, str], bytes]:
        """First line, the named fields up to the empty line, and all their bytes."""
        while (end := self.buffer.find(EOL + EOL)) < 0:
            more = next(self.chunks, b"")
            if not more:
                raise ValueError("record without an end of its fields")
            self.buffer += more
        raw, self.buffer = self.buffer[: end + 4], self.buffer[end + 4 :]
        first, *lines = raw[:end].decode("utf-8", "replace").split("\r\n")
        named = (line.partition(":") for line in lines)
        return first, {name.strip().lower(): value.strip() for name, _, value in named}, raw

    def take(self, length: int) -> Iterator[bytes]:
        """The next ``length`` bytes, in parts."""
        while length > 0:
            data = self.buffer or next(self.chunks, b"")
            if not data:
                raise ValueError("record shorter than its length")
            part, self.buffer = data[:length], data[length:]
            length -= len(part)
            yield part

    def ends(self) -> bool:
        """Nothing but the closing empty lines is left."""
        return self.buffer + b"".join(self.chunks) == EOL + EOL


def read_record(chunks: Iterator[bytes], keep_payload: bool = False) -> dict:
    """One record: its fields, its payload's size and digest, and whether it is sound.

    ``verified`` means that the record has the length it names and nothing
    behind it, and that block and payload have the digests it names. A revisit
    has no payload of its own to hold against its digest; see ``_revisits_held``.
    """
    framed = Framed(chunks)
    version, fields, _ = framed.fields()
    if not version.startswith("WARC/"):
        raise ValueError(f"no WARC record: {version[:40]!r}")
    length = int(fields["content-length"])
    block, payload, size, body = hashlib.sha256(), hashlib.sha256(), 0, []
    if fields.get("content-type", "").startswith("application/http"):
        _, _, head = framed.fields()
        block.update(head)
        length -= len(head)
    for part in framed.take(length):
        block.update(part)
        payload.update(part)
        size += len(part)
        if keep_payload:
            body.append(part)
    revisit = fields["warc-type"] == "revisit"
    named = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    digest = named if revisit else payload.hexdigest()
    named_block = fields.get("warc-block-digest", "").removeprefix("sha256:")
    return {
        "fields": fields,
        "payload": b"".join(body) if keep_payload and not revisit else None,
        "payload_bytes": int(fields["x-payload-length"]) if revisit else size,
        "payload_digest": digest,
        "verified": framed.ends()
        and digest == named
        and named_block in ("", block.hexdigest()),
    }


def _page_id(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


READ = (
    "page_id long, url string, record_type string, payload_bytes long, "
    "payload_digest string, refers_to long, verified boolean"
)


def read_archives(
    spark: SparkSession, archives: DataFrame, keep_payload: bool = False
) -> DataFrame:
    """The page records of the archives named in the column ``path``, read in order.

    A task reads an archive as a stream: member by member, inflating a bounded
    part at a time, each record framed by its content length. Broken archives
    raise an error; records whose digests do not hold have ``verified`` false.
    A revisit names the page it repeats in ``refers_to``; its size and digest are
    those of that page's payload, and it is verified only if these archives hold a
    response of that page whose payload, as read, has them. With ``keep_payload``
    responses carry their payload, and archives are read a second time for it. No
    archives give an empty result.
    """
    found = settle(_records(archives, False), "records")
    whole = _records(archives, True) if keep_payload else found
    names = whole.columns
    again = F.col("record_type") == "revisit"
    revisits = _revisits_held(whole.where(again), found)
    return whole.where(~again).unionByName(revisits.select(*names))


def _target(page: str) -> Column:
    return F.concat_ws(" ", page, "payload_digest", "payload_bytes")


def _revisits_held(revisits: DataFrame, found: DataFrame) -> DataFrame:
    """Revisits, verified only beside a response of the same page, digest and size.

    One response may be revisited by any share of the records.
    """
    named = found.where("record_type = 'revisit'").select(_target("refers_to").alias("_target"))
    held = (
        found.where("record_type <> 'revisit' AND page_id IS NOT NULL")
        .select(_target("page_id").alias("_target"))
        .distinct()
        .join(named.distinct(), "_target", "left_semi")
        .withColumn("_held", F.lit(True))
    )
    asked = revisits.withColumn("_target", _target("refers_to"))
    joined = salted_join(asked, held, "_target", ("page_id", "url"), "left")
    return joined.withColumn("verified", F.col("verified") & F.col("_held").isNotNull())


def _records(archives: DataFrame, keep_payload: bool) -> DataFrame:
    schema = READ + (", payload binary" if keep_payload else "")
    names = [field.split()[0] for field in schema.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
    types += [pa.binary()] * keep_payload

    def batch(rows: list[list]) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for paths in batches:
            for path in paths.column(0).to_pylist():
                store, plain = open_store(path)
                rows, held = [], 0
                with store.open_input_stream(plain, compression=None) as stream:
                    for chunks in members(stream):
                        got = read_record(chunks, keep_payload)
                        fields = got["fields"]
                        rows.append(
                            [
                                _page_id(fields.get("warc-record-id")),
                                fields.get("warc-target-uri"),
                                fields["warc-type"],
                                got["payload_bytes"],
                                got["payload_digest"],
                                _page_id(fields.get("warc-refers-to")),
                                got["verified"],
                                *[got["payload"]] * keep_payload,
                            ]
                        )
                        held += 500 + len(got["payload"] or b"")
                        if held >= 16 << 20:
                            yield batch(rows)
                            rows, held = [], 0
                if rows:
                    yield batch(rows)

    files = archives.select("path")
    return files.repartition(max(1, files.count())).mapInArrow(read, schema)
