"""Tokens per document by a two-tier lookup inside the tasks.

No text is shuffled. Only the reports that fill the table of frequent pieces are
added up by piece: at most ``REPORTED_ENTRIES`` rows per task, so that shuffle
grows with the number of tasks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tokens import CACHED_BYTES, Cache, byte_level_pieces, grouped

#: Entries of the broadcast table: with pieces of at most 64 bytes, 5 MB at the most.
TABLE_ENTRIES = 65_536
#: Pieces a task counts at a time, and those it reports.
COUNTED_ENTRIES = 400_000
REPORTED_ENTRIES = 20_000


def frequent_pieces(
    docs: DataFrame, text: str = "text", entries: int = TABLE_ENTRIES
) -> dict[bytes, int]:
    """Frequent pre-tokens of all documents with lower bounds of their counts, at most ``entries``.

    Every task counts its own texts in bounded memory (rare pieces are dropped
    when the counter is full) and reports its most frequent pieces; only these
    reports are added up. What a task dropped or did not report is missing from a
    count, so counts may be too low and a piece may be missed; the table is used
    for speed alone. What is missed costs time later, never a token.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for texts in grouped(value.as_py() for value in batch.column(0)):
                for one in texts:
                    seen.update(byte_level_pieces(one) or ())
                if len(seen) > COUNTED_ENTRIES:
                    seen = Counter(dict(seen.most_common(COUNTED_ENTRIES // 2)))
        top = [(p, n) for p, n in seen.most_common(REPORTED_ENTRIES) if len(p) <= CACHED_BYTES]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in top], pa.binary()), pa.array([n for _, n in top], pa.int64())],
            names=["piece", "n"],
        )

    reports = docs.select(F.col(text)).mapInArrow(count, "piece binary, n long")
    summed = reports.groupBy("piece").agg(F.sum("n").alias("n"))
    top = summed.orderBy(F.desc("n"), "piece").limit(entries).collect()
    return {bytes(row["piece"]): row["n"] for row in top}


_CACHES: dict = {}


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int = 512,
    doc: str = "doc_id",
    text: str = "text",
    entries: int = TABLE_ENTRIES,
) -> DataFrame:
    """Bytes and tokens of every document, by a byte-level tokenizer of the tokenizers library.

    Texts are cut where that tokenizer cuts anyway. The lengths of the frequent
    pieces are broadcast (a table of at most ``entries``); other pieces are
    encoded once per worker and kept in its bounded cache. Only the reports behind the
    table are shuffled by piece. Texts with white space beyond ASCII are encoded whole.

    A null text is an empty one: no bytes, no tokens. Ids may be null or repeated;
    an empty table gives an empty result. Only the two named columns are read.
    """
    spark = docs.sparkSession
    frequent = list(frequent_pieces(docs, text, entries))
    own = Cache(tokenizer_path, len)
    own.learn(frequent)
    table = spark.sparkContext.broadcast({p: own.held[p] for p in frequent})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (tokenizer_path, table.id if hasattr(table, "id") else id(table))
        if key not in _CACHES:
            _CACHES.clear()
            _CACHES[key] = Cache(tokenizer_path, len, table.value)
        cache = _CACHES[key]
        for batch in batches:
            sizes, tokens = [], []
            for texts in grouped(value.as_py() for value in batch.column(1)):
                split = [byte_level_pieces(one) for one in texts]
                cache.learn(piece for pieces in split if pieces for piece in pieces)
                for one, pieces in zip(texts, split):
                    sizes.append(len(one.encode()))
                    tokens.append(
                        cache.once(one.encode())
                        if pieces is None
                        else sum(cache.values(pieces))
                    )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    read = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return read.mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
