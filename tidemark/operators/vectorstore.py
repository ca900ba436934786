"""Vector records kept in buckets, so that an update rewrites only what it touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.vectors import NAMESPACE, upsert_vectors
from tidemark.plans.storage import settle
from tidemark.sources.schemas import VECTOR_RECORD
from tidemark.sources.snapshots import Snapshot, current, new_folder, publish, read_parts

BUCKETS = 64
KEY = ["namespace", "id"]
_BUCKET, _COUNT = "_bucket", "buckets"


def _bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("int")


def buckets_of(spark: SparkSession, path: str) -> int | None:
    """Number of buckets of a store; None where there is none yet."""
    count = current(spark, path).notes.get(_COUNT)
    return None if count is None else int(count)


def write_updates(updates: DataFrame, path: str, buckets: int = BUCKETS) -> list[int]:
    """Put ``updates`` into the store under ``path``: per namespace and id the last
    write wins, by the timestamp in its metadata among several of one call.

    Updates are reduced to one row per id first, inside the tasks. Then only the
    buckets they fall into are read, merged and written, into new folders; the list of
    folders is swapped last. A call that dies before the swap changes nothing; one
    that finds another writer's swap raises ``snapshots.Conflict`` and may be repeated.

    ``buckets`` holds for a new store; an existing one keeps its number. A bucket is
    an even share of all ids, whatever their names, and is cut into several files
    when large. Returns the buckets written; none for an empty table. Rows without
    an id or namespace are records like others, equal to one another.
    """
    spark = updates.sparkSession
    base = current(spark, path)
    count = int(base.notes.get(_COUNT, buckets))
    fresh = upsert_vectors(updates.limit(0), updates.select("namespace", "id", "values", "metadata"))
    fresh = settle(fresh.withColumn(_BUCKET, _bucket_of(count)), "updates")
    # As many numbers as the store has buckets at most.
    touched = sorted(row[0] for row in fresh.select(_BUCKET).distinct().collect())
    if not touched:
        return []
    old = read_parts(spark, path, VECTOR_RECORD, [base.parts[str(b)] for b in touched if str(b) in base.parts])
    merged = upsert_vectors(old, fresh.drop(_BUCKET)).withColumn(_BUCKET, _bucket_of(count))
    folder = new_folder(path)
    # Rebalancing keeps a bucket together and cuts one that is too large for a task.
    merged.hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(f"{path}/{folder}")
    parts = dict(base.parts) | {str(b): f"{folder}/{_BUCKET}={b}" for b in touched}
    publish(spark, path, base, parts, {_COUNT: str(count)})
    return touched


def read_store(spark: SparkSession, path: str, snapshot: Snapshot | None = None) -> DataFrame:
    """All records of the store, as they were when it was opened."""
    found = snapshot or current(spark, path)
    return read_parts(spark, path, VECTOR_RECORD, list(found.parts.values()))


def read_records(
    spark: SparkSession, path: str, ids: Sequence[str], namespace: str = NAMESPACE
) -> DataFrame:
    """The records of some ids (a list in memory), from their buckets alone."""
    found = current(spark, path)
    if not found.parts or not ids:
        return read_parts(spark, path, VECTOR_RECORD, [])
    wanted = spark.createDataFrame([(namespace, i) for i in ids], "namespace string, id string")
    count = int(found.notes[_COUNT])
    numbers = {str(row[0]) for row in wanted.select(_bucket_of(count)).distinct().collect()}
    folders = [folder for name, folder in found.parts.items() if name in numbers]
    rows = read_parts(spark, path, VECTOR_RECORD, folders)
    return rows.filter((F.col("namespace") == namespace) & F.col("id").isin(list(ids)))
