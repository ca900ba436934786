"""Vectors as short codes: codebooks per part, distances from value dictionaries."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.embeddings import matrix, whole_numbers
from tidemark.plans.skew import salted_join
from tidemark.plans.storage import settle

PARTS = 4
#: Entries of a codebook; a code has two hex digits a part.
ENTRIES = 256
ROUNDS = 4
#: Rows whose distances to all entries are held at a time.
CHUNK = 2048


def bounds(length: int, parts: int = PARTS) -> list[tuple[int, int]]:
    """Where the parts of a vector begin and end, as equal as its length allows."""
    cuts = [part * length // parts for part in range(parts + 1)]
    return list(zip(cuts, cuts[1:]))


def as_dictionaries(rows: DataFrame, length: int) -> DataFrame:
    """Blocks of rows: per dimension the distinct integers, per row their numbers.

    A block is one Arrow batch, so a dictionary holds no more integers than the
    batch has rows, whatever the spread of values.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            if not batch.num_rows:
                continue
            found = [np.unique(one, return_inverse=True) for one in matrix(batch.column("x"), length).T]
            yield pa.RecordBatch.from_pydict(
                {
                    "ids": pa.ListArray.from_arrays([0, batch.num_rows], batch.column("id")),
                    "labels": pa.ListArray.from_arrays([0, batch.num_rows], batch.column("label")),
                    "sizes": pa.array([[len(values) for values, _ in found]], pa.list_(pa.int32())),
                    "dictionary": [np.concatenate([values for values, _ in found]).tobytes()],
                    "codes": [np.stack([codes for _, codes in found]).astype("int32").tobytes()],
                }
            )

    kinds = dict(rows.dtypes)
    schema = (
        f"ids array<{kinds['id']}>, labels array<{kinds['label']}>, "
        "sizes array<int>, dictionary binary, codes binary"
    )
    return rows.mapInArrow(encode, schema)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(ids, labels, dictionaries, codes per dimension) of every block."""
    import numpy as np

    for batch in batches:
        for row in range(batch.num_rows):
            sizes = batch.column("sizes")[row].values.to_numpy()
            values = np.frombuffer(batch.column("dictionary")[row].as_buffer(), "int64")
            codes = np.frombuffer(batch.column("codes")[row].as_buffer(), "int32")
            yield (
                batch.column("ids")[row].values,
                batch.column("labels")[row].values,
                np.split(values, np.cumsum(sizes)[:-1]),
                codes.reshape(len(sizes), -1),
            )


def _exact_kind(largest: int) -> str:
    """The narrowest type that holds whole numbers up to ``largest``."""
    return "int32" if largest < 2**31 else "int64" if largest < 2**63 else "object"


def nearest(dictionaries: list, codes, book) -> tuple:
    """(entry, squared distance) of every row's part; ties go to the lower entry.

    ``book`` has an entry a row. For every dimension the squared differences of its
    distinct integers to all entries are tabulated once; a row's distances are then
    sums of the table rows that its codes name.
    """
    import numpy as np

    count = codes.shape[1]
    widest = 0
    for values, entries in zip(dictionaries, book.T):
        ends = [int(values[0]) - int(entries.max()), int(values[-1]) - int(entries.min())]
        widest += max(end * end for end in ends)
    kind = _exact_kind(widest)
    tables = [
        (values.astype(kind)[:, None] - entries.astype(kind)) ** 2
        for values, entries in zip(dictionaries, book.T)
    ]
    entry, error = np.zeros(count, "int64"), np.zeros(count, "object" if kind == "object" else "int64")
    for at in range(0, count, CHUNK):
        own = codes[:, at : at + CHUNK]
        distances = np.zeros((own.shape[1], len(book)), kind)
        for table, numbers in zip(tables, own):
            distances += table[numbers]
        entry[at : at + CHUNK] = best = distances.argmin(axis=1)
        error[at : at + CHUNK] = distances[np.arange(len(best)), best]
    return entry, error


def _gathered(blocks: DataFrame, books: list, cuts: list) -> list:
    """Per part the number and the exact sums of the parts assigned to each entry.

    A task adds its own rows up first and sends at most one row per entry.
    """
    import numpy as np

    shared = blocks.sparkSession.sparkContext.broadcast(books)
    widths = [stop - start for start, stop in cuts]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        counts = [np.zeros(len(book), "int64") for book in books]
        sums = [np.zeros(book.shape, "int64") for book in books]
        for _, _, dictionaries, codes in _blocks(batches):
            for part, (start, stop) in enumerate(cuts):
                entry, _ = nearest(dictionaries[start:stop], codes[start:stop], books[part])
                counts[part] += np.bincount(entry, minlength=len(books[part]))
                order = np.argsort(entry, kind="stable")
                used, first = np.unique(entry[order], return_index=True)
                for k, at in enumerate(range(start, stop)):
                    values = dictionaries[at][codes[at][order]]
                    sums[part][used, k] += np.add.reduceat(values, first)
        for part, (count, total) in enumerate(zip(counts, sums)):
            used = np.flatnonzero(count)
            if len(used):
                padded = np.zeros((len(used), max(widths)), "int64")
                padded[:, : widths[part]] = total[used]
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([part] * len(used), pa.int32()),
                        "entry": pa.array(used, pa.int32()),
                        "members": count[used],
                        "sums": list(padded),
                    }
                )

    partial = blocks.mapInArrow(add_up, "part int, entry int, members long, sums array<long>")
    totals = [F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(max(widths))]
    found = partial.groupBy("part", "entry").agg(F.sum("members").alias("members"), *totals)
    rows = found.collect()
    shared.unpersist()
    return rows


def train(rows: DataFrame, blocks: DataFrame, length: int, parts: int, entries: int, rounds: int) -> list:
    """Codebooks after ``rounds`` of assigning all parts and averaging, in whole numbers.

    They start as the parts of the rows with the smallest ids (nulls last, equal ids
    by their vectors); with fewer rows than entries they have an entry a row.
    """
    import numpy as np

    order = [F.asc_nulls_last("id"), "x"]
    first = rows.select("id", "x").orderBy(*order).limit(entries).orderBy(*order).collect()
    if not first:
        return []
    whole = np.array([row["x"] for row in first], "int64")
    cuts = bounds(length, parts)
    books = [whole[:, start:stop].copy() for start, stop in cuts]
    for _ in range(rounds):
        for row in _gathered(blocks, books, cuts):
            book, members = books[row["part"]], row["members"]
            sums = [row[f"s{k}"] for k in range(book.shape[1])]
            book[row["entry"]] = [total // members for total in sums]
    return books


def fingerprint(books: list) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and position."""
    numbers = ",".join(str(x) for book in books for x in book.ravel().tolist())
    return hashlib.sha256(numbers.encode()).hexdigest()


def assign(blocks: DataFrame, books: list, length: int, parts: int, kinds: dict) -> DataFrame:
    """(id, label, code, error): every row with the numbers of its nearest entries."""
    shared = blocks.sparkSession.sparkContext.broadcast(books)
    cuts = bounds(length, parts)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for ids, labels, dictionaries, codes in _blocks(batches):
            found = [
                nearest(dictionaries[start:stop], codes[start:stop], book)
                for (start, stop), book in zip(cuts, shared.value)
            ]
            entries = np.stack([entry for entry, _ in found], axis=1).astype("uint8")
            names = [row.tobytes().hex() for row in entries]
            errors = sum(error for _, error in found)
            yield pa.RecordBatch.from_arrays(
                [ids, labels, pa.array(names, pa.string()), pa.array(errors.tolist(), pa.int64())],
                names=["id", "label", "code", "error"],
            )

    schema = f"id {kinds['id']}, label {kinds['label']}, code string, error long"
    return blocks.mapInArrow(judge, schema)


def compress(
    df: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Every usable vector as a code of ``parts`` bytes.

    Columns: the id, ``code`` (two hex digits a part), ``error`` (squared distances
    to the entries, added over the parts), ``label_error`` (errors of all rows of the
    same label, null being a label too) and ``codebooks_sha256``.

    Rows whose vector is null or empty, holds a null or non-finite entry, or is not
    of the most frequent length are left out. Ids may be null or repeated: such rows
    are coded like others. Equal parts get equal entries, equal distances the lower
    one. An empty table gives an empty result. Other columns are not read. A code
    byte holds at most 256 ``entries``. Distances and sums are exact; they must fit
    64 bits in the result.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be between 1 and 256")
    chosen = whole_numbers(df, {"id": id_column, "label": label}, vector, 0)
    rows = settle(chosen, "vectors")
    kinds = dict(rows.dtypes)
    one = rows.select(F.size("x").alias("length")).first()
    if one is None:
        empty = (
            f"`{id_column}` {kinds['id']}, code string, error long, "
            "label_error long, codebooks_sha256 string"
        )
        return df.sparkSession.createDataFrame([], empty)
    length = one["length"]
    blocks = settle(as_dictionaries(rows, length), "blocks")
    books = train(rows, blocks, length, parts, entries, rounds)
    coded = settle(assign(blocks, books, length, parts, kinds), "codes")
    # Equal labels have equal keys, and a null label has one of its own.
    key = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("none"))
    keyed = coded.withColumn("_key", key)
    sums = keyed.groupBy("_key").agg(F.sum("error").alias("label_error"))
    return salted_join(keyed, sums, "_key", ("id", "code")).select(
        F.col("id").alias(id_column),
        "code",
        "error",
        "label_error",
        F.lit(fingerprint(books)).alias("codebooks_sha256"),
    )
