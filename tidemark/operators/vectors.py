"""Vector records: upsert, exact cosine search, similar records, search in batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import snap_round
from tidemark.functions.vectors import match_columns
from tidemark.operators.serving import check_bounds

# Namespace of the records, result sizes and score digits.
NAMESPACE = "market-data"
SEARCH_TOP_K = 10
SIMILAR_TOP_K = 5
SCORE_DIGITS = 4

# Query vectors handed to the tasks at a time; more are searched in further passes.
QUERIES_PER_PASS = 4096
# Times a part may be halved before its ids must be the same.
MAX_SPLITS = 1024


def upsert_vectors(existing: DataFrame, updates: DataFrame) -> DataFrame:
    """Records after writing ``updates``: per namespace and id the last write wins.

    A maximum per key combines inside each task first, so an id written a
    billion times costs one row per task.
    """
    written = existing.withColumn("_batch", F.lit(0)).unionByName(
        updates.withColumn("_batch", F.lit(1))
    )
    record = F.struct("values", "metadata")
    order = F.struct("_batch", F.col("metadata.timestamp"), "values")
    return (
        written.groupBy("namespace", "id")
        .agg(F.max_by(record, order).alias("_last"))
        .select("namespace", "id", "_last.values", "_last.metadata")
    )


def _stored(
    vectors: DataFrame, symbol: str | None = None, sentiment: str | None = None
) -> DataFrame:
    """Records of the namespace that pass the metadata filters."""
    chosen = vectors.filter(F.col("namespace") == NAMESPACE)
    if symbol:
        chosen = chosen.filter(F.col("metadata.symbol") == symbol.upper())
    if sentiment:
        chosen = chosen.filter(
            F.col("metadata.sentiment_category") == sentiment.upper()
        )
    return chosen


def _nearest_in_task(
    vectors: DataFrame, queries: Sequence[tuple[str, Sequence[float]]], k: int
) -> DataFrame:
    """(query_id, id, score): the k best records each task finds for each query.

    ``queries`` is a bounded list. Vectors are compared batch by batch as
    matrices; equal scores are ordered by id, so the outcome does not depend on
    how the rows are spread over tasks.
    """
    names = [name for name, _ in queries]
    matrix = np.array([values for _, values in queries], dtype="float64")
    dims = matrix.shape[1]
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    unit = np.divide(matrix, lengths, out=np.full_like(matrix, np.nan), where=lengths > 0)
    shared = vectors.sparkSession.sparkContext.broadcast((names, unit))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, wanted = shared.value
        ids = [np.empty(0, dtype=object) for _ in names]
        best = [np.empty(0) for _ in names]
        floor = np.full(len(names), -2.0)
        for batch in batches:
            flat = batch.column("values").flatten().to_numpy(zero_copy_only=False)
            rows = flat.astype("float64").reshape(-1, dims)
            norms = np.linalg.norm(rows, axis=1)
            with np.errstate(invalid="ignore", divide="ignore"):
                scores = np.round((rows @ wanted.T) / norms[:, None], 9)
                near = scores >= floor
            for q in np.flatnonzero(near.any(axis=0)):
                hits = np.flatnonzero(near[:, q])
                if len(hits) > k:
                    # Keep all rows at or above the k-th best, ties included.
                    cut = np.partition(scores[hits, q], -k)[-k]
                    hits = hits[scores[hits, q] >= cut]
                found = batch.column("id").take(pa.array(hits)).to_pylist()
                all_ids = np.append(ids[q], np.array(found, dtype=object))
                all_scores = np.append(best[q], scores[hits, q])
                order = np.lexsort((all_ids.astype(str), -all_scores))[:k]
                ids[q], best[q] = all_ids[order], all_scores[order]
                if len(order) == k:
                    floor[q] = best[q][-1]
        for name, found, score in zip(names, ids, best):
            yield pa.RecordBatch.from_pydict(
                {
                    "query_id": pa.array([name] * len(found), pa.string()),
                    "id": pa.array(found.tolist(), pa.string()),
                    "score": pa.array(score, pa.float64()),
                }
            )

    return (
        vectors.filter(F.size("values") == dims)
        .select("id", "values")
        .mapInArrow(scan, "query_id string, id string, score double")
    )


def _matches(vectors: DataFrame, query: Sequence[float], k: int) -> DataFrame:
    """The k best records of all tasks with their metadata.

    Vectors are scanned alone; the metadata is read for the matches only, by a
    join whose small side has at most k rows (k is range-checked).
    """
    best = (
        _nearest_in_task(vectors, [("", query)], k)
        .select("id", "score")
        .orderBy(F.desc("score"), "id")
        .limit(k)
    )
    records = vectors.select("id", "metadata")
    return records.join(F.broadcast(best), "id")


def semantic_search(
    vectors: DataFrame,
    query: Sequence[float],
    top_k: int = SEARCH_TOP_K,
    symbol: str | None = None,
    sentiment: str | None = None,
    min_score: float | None = None,
) -> DataFrame:
    """Records nearest to a query vector, best first.

    ``min_score`` is applied to the k matches, so fewer than k may come back;
    zero means no minimum.
    """
    check_bounds(search_top_k=top_k, min_score=min_score)
    matches = _matches(_stored(vectors, symbol, sentiment), query, top_k)
    if min_score:
        matches = matches.filter(F.col("score") >= min_score)
    return matches.orderBy(F.desc("score"), "id").select(
        "id",
        snap_round(F.col("score"), SCORE_DIGITS).alias("score"),
        *[column.alias(name) for name, column in match_columns().items()],
    )


def find_similar(
    vectors: DataFrame, record_id: str, top_k: int = SIMILAR_TOP_K
) -> DataFrame:
    """Records nearest to a stored one, itself left out; no row for an unknown id."""
    check_bounds(similar_top_k=top_k)
    stored = _stored(vectors)
    others = stored.filter(F.col("id") != record_id)
    target = stored.filter(F.col("id") == record_id).select("values").head()
    if target is None:
        matches = others.withColumn("score", F.lit(None).cast("double")).limit(0)
    else:
        matches = _matches(others, target["values"], top_k)
    wanted = ["symbol", "sentiment_score", "sentiment_category", "news_headline", "timestamp"]
    columns = match_columns()
    return matches.orderBy(F.desc("score"), "id").select(
        "id",
        snap_round(F.col("score"), SCORE_DIGITS).alias("similarity_score"),
        *[columns[name].alias(name) for name in wanted],
    )


def _bounded_parts(
    queries: DataFrame, size: int
) -> Iterator[list[tuple[str, Sequence[float]]]]:
    """All queries in lists of at most ``size``, cut by a hash of their ids.

    A part that turns out too long is cut in two and read again.
    """
    number = max(1, -(-queries.count() // size))
    parts = [(number, rest) for rest in range(number)]
    while parts:
        modulus, rest = parts.pop()
        chosen = F.pmod(F.xxhash64("query_id"), F.lit(modulus)) == rest
        rows = queries.filter(chosen).limit(size + 1).collect()
        if len(rows) > size:
            if modulus > number * MAX_SPLITS:
                raise ValueError("query ids must be unique")
            parts += [(modulus * 2, rest), (modulus * 2, rest + modulus)]
        elif rows:
            yield [(row["query_id"], row["values"]) for row in rows]


def search_batch(
    vectors: DataFrame,
    queries: DataFrame,
    top_k: int = SEARCH_TOP_K,
    queries_per_pass: int = QUERIES_PER_PASS,
) -> DataFrame:
    """Exact nearest records of many query vectors (``query_id``, ``values``).

    The vectors are read once per pass and compared as matrices inside the
    tasks; a task sends k rows per query, never a pair list. A pass holds a
    bounded number of queries: a larger batch is split by a hash of its ids,
    which must be unique, and every part is searched.
    """
    check_bounds(search_top_k=top_k)
    stored = _stored(vectors)
    asked = queries.select(F.col("query_id").cast("string"), "values").filter(
        F.col("values").isNotNull()
    )
    found = [
        _nearest_in_task(stored, part, top_k)
        for part in _bounded_parts(asked, queries_per_pass)
    ]
    if not found:
        nothing = "query_id string, position int, id string, score double"
        return asked.sparkSession.createDataFrame([], nothing)
    position = F.row_number().over(
        Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    )
    return (
        reduce(DataFrame.unionByName, found)
        .withColumn("position", position)
        .filter(F.col("position") <= top_k)
        .select(
            "query_id",
            "position",
            "id",
            snap_round(F.col("score"), SCORE_DIGITS).alias("score"),
        )
    )
