"""Token sequences packed by first-fit decreasing with a tournament tree."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tokens import WordCache, grouped
from tidemark.plans.storage import settle

CAPACITY = 4096
#: Pieces that one group packs; bounds a task's memory at some tens of MB.
GROUP_PIECES = 50_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _packed_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_CACHES: dict[str, WordCache] = {}


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 2,
    capacity: int = CAPACITY,
    doc: str = "doc_id",
    text: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """Every document as tokens, cut into pieces of at most ``capacity``.

    A piece has its document, the tokens of it before the piece, its length, the
    checksum of its ids (little-endian unsigned 32 bit) and the tokens of the
    whole document, end id included; with ``keep_ids`` also the ids themselves.
    The tokenizer must treat words between ASCII white space apart from each
    other, as those that drop white space do.

    A null text is an empty one: a single piece of the end id. Repeated rows are
    documents of their own, and a null id stays null. Only two columns are read.
    """
    schema = PIECES + (", ids array<long>" if keep_ids else "")
    end = struct.pack("<I", end_id)
    size = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        cache = _CACHES.setdefault(tokenizer_path, WordCache(tokenizer_path, _packed_ids))
        for batch in batches:
            ids = iter(batch.column(0).to_pylist())
            for texts in grouped(value.as_py() for value in batch.column(1)):
                split = [t.encode().split() for t in texts]
                cache.learn(word for words in split for word in words)
                rows = []
                for words in split:
                    doc_id = next(ids)
                    blob = b"".join(cache.values(words)) + end
                    total = len(blob) // 4
                    for at in range(0, len(blob), size):
                        part = blob[at : at + size]
                        row = [doc_id, at // 4, len(part) // 4, zlib.crc32(part), total]
                        if keep_ids:
                            row.append(np.frombuffer(part, "<u4").astype("int64"))
                        rows.append(row)
                columns = list(zip(*rows))
                types = [pa.int64()] * 5 + [pa.list_(pa.int64())] * keep_ids
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)],
                    names=[f.split()[0] for f in schema.split(", ")],
                )

    read = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return read.mapInArrow(cut, schema)


class Tournament:
    """Bins in order; each inner node knows the largest free space below it."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.free = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """Put ``size`` into the first bin with room; gives the bin and the space left in it."""
        free, node = self.free, 1
        while node < self.leaves:
            node *= 2
            if free[node] < size:
                node += 1
        left = free[node] = free[node] - size
        bin_ = node - self.leaves
        while node > 1:
            node //= 2
            most = max(free[2 * node], free[2 * node + 1])
            if free[node] == most:
                break
            free[node] = most
        return bin_, left


def first_fit_decreasing(lengths, capacity: int = CAPACITY):
    """Bin and offset of every length; equal lengths keep their order."""
    import numpy as np

    bins = np.empty(len(lengths), "int64")
    offsets = np.empty(len(lengths), "int64")
    tree = Tournament(max(1, len(lengths)), capacity)
    for i in np.argsort(-np.asarray(lengths, "int64"), kind="stable").tolist():
        size = int(lengths[i])
        bins[i], left = tree.place(size)
        offsets[i] = capacity - left - size
    return bins, offsets


def pack(
    pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES
) -> DataFrame:
    """``pieces`` with the sequence each goes into and its offset there.

    Pieces are dealt at random, not by a key, into groups of about
    ``group_pieces``; each group is packed by itself, so that no group depends on
    how often an id or a length occurs. Sequence numbers hold the group in their
    upper 32 bits. An empty table stays empty. Columns named ``sequence_id`` and
    ``offset`` are replaced.
    """
    settled = settle(pieces.drop("sequence_id", "offset"), "token-pieces")
    groups = max(1, -(-settled.count() // group_pieces))
    schema = settled.schema.add("sequence_id", "long").add("offset", "long")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        bins, offsets = first_fit_decreasing(rows.column("length").to_numpy(), capacity)
        sequences = bins + (TaskContext.get().partitionId() << 32)
        rows = rows.append_column("sequence_id", pa.array(sequences))
        rows = rows.append_column("offset", pa.array(offsets))
        yield from rows.to_batches(max_chunksize=10_000)

    return settled.repartition(groups).mapInArrow(fill, schema)
