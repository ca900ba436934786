"""Uniqueness over all appends, from a ledger of fingerprints instead of the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import column_type
from tidemark.plans.storage import settle
from tidemark.sources.snapshots import Snapshot, current, new_folder, publish, read_parts

BUCKETS = 64
#: ``value`` is kept only of values that occur more than once.
LEDGER = "mark binary, n_records long, value string"
_BUCKET, _COUNT, _TYPE, _LAST = "_bucket", "buckets", "type", "last"


def _bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("mark"), F.lit(buckets)).cast("int")


def _summed(counts: DataFrame) -> DataFrame:
    """One row per fingerprint. What repeats is in the newest batch or was kept before."""
    n = F.sum("n_records")
    return counts.groupBy("mark").agg(
        n.alias("n_records"), F.when(n > 1, F.max("value")).alias("value")
    )


def append_values(
    batch: DataFrame, column: str, path: str, batch_id: str | None = None, buckets: int = BUCKETS
) -> list[int]:
    """Count the values of an appended batch in the ledger under ``path``.

    The batch is reduced to one row per value in the tasks, so a hot value is one row
    per task. Values are kept as fingerprints of 128 bits (MD5 of the value as text)
    with their number; only the buckets that the batch meets are read and rewritten,
    and the table itself is not read again. The list of folders is swapped last: a
    crash counts nothing, ``snapshots.Conflict`` tells that another was faster.

    ``batch_id`` makes a repeat of the newest batch count once, as a stream's sink
    needs it. ``buckets`` holds for a new ledger. Nulls are not counted; the empty
    text is a value. Returns the buckets written; none for a batch without values.
    """
    spark = batch.sparkSession
    base = current(spark, path)
    if batch_id is not None and base.notes.get(_LAST) == batch_id:
        return []
    kind = column_type(batch, column)
    if base.notes.get(_TYPE, kind) != kind:
        raise ValueError(f"{column} is {kind}, the ledger holds {base.notes[_TYPE]}")
    count = int(base.notes.get(_COUNT, buckets))
    text = F.col(column).cast("string")
    values = batch.filter(F.col(column).isNotNull()).groupBy(text.alias("value"))
    fresh = values.agg(F.count("*").alias("n_records")).select(
        F.unhex(F.md5("value")).alias("mark"), "n_records", "value"
    )
    fresh = settle(fresh.withColumn(_BUCKET, _bucket_of(count)), "fresh-values")
    # As many numbers as the ledger has buckets at most.
    touched = sorted(row[0] for row in fresh.select(_BUCKET).distinct().collect())
    parts = dict(base.parts)
    if touched:
        folders = [base.parts[str(b)] for b in touched if str(b) in base.parts]
        merged = _summed(read_parts(spark, path, LEDGER, folders).unionByName(fresh.drop(_BUCKET)))
        folder = new_folder(path)
        (
            merged.withColumn(_BUCKET, _bucket_of(count))
            .hint("rebalance", _BUCKET)
            .write.partitionBy(_BUCKET)
            .parquet(f"{path}/{folder}")
        )
        parts |= {str(b): f"{folder}/{_BUCKET}={b}" for b in touched}
    notes = {_COUNT: str(count), _TYPE: kind} | ({_LAST: batch_id} if batch_id is not None else {})
    publish(spark, path, base, parts, notes)
    return touched


def _typed(rows: DataFrame, column: str, found: Snapshot) -> DataFrame:
    value = F.col("value").cast(found.notes.get(_TYPE, "string"))
    return rows.select(value.alias(column), "n_records")


def repeated_values(
    spark: SparkSession, path: str, column: str, snapshot: Snapshot | None = None
) -> DataFrame:
    """Values that occur more than once in all batches, with their number.

    The rows of ``quality.failing_unique`` over the whole table; ``value`` is null for
    all others, so the scan skips the row groups without repeats.
    """
    found = snapshot or current(spark, path)
    rows = read_parts(spark, path, LEDGER, list(found.parts.values()))
    return _typed(rows.filter("n_records > 1"), column, found)


def totals(spark: SparkSession, path: str) -> DataFrame:
    """One row for the uniqueness check: element_count, distinct_count, unexpected_count.

    All rows of a repeated value are unexpected; nulls are in no figure.
    """
    rows = read_parts(spark, path, LEDGER, list(current(spark, path).parts.values()))
    n = F.col("n_records")
    return rows.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("element_count"),
        F.count("*").alias("distinct_count"),
        F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).alias("unexpected_count"),
    )
