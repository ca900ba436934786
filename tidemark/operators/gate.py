"""Appends that take effect only if their rows pass a suite: write, audit, publish."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.types import StructType

from tidemark.operators import quality
from tidemark.sources.snapshots import Snapshot, current, new_folder, publish, read_parts


def append_checked(
    df: DataFrame,
    path: str,
    suite: str | Sequence[quality.Check],
    checkpoint_name: str,
    table_name: str,
    run_time: datetime,
) -> DataFrame:
    """Append ``df`` to the table under ``path`` if it passes ``suite``; gives the log row.

    The rows are computed once: the counters of all row-wise checks are taken while
    they are written, in the writing stage itself, where a repeated task counts once.
    Uniqueness reads its one column back from the written folder. Only then the
    list of folders is swapped. A batch that fails, or whose job fails, stays
    unpublished and its log row says why; ``snapshots.drop_unlisted`` deletes its folder.
    ``snapshots.Conflict`` tells that another writer has published first.

    Uniqueness is that of the batch; ``idledger`` judges it over all appends. An
    empty batch passes what an empty table passes and adds no rows.
    """
    spark = df.sparkSession
    base = current(spark, path)
    folder = new_folder(path)
    row_wise, apart = quality.split_suite(suite)

    def judge() -> list:
        seen = Observation()
        observed = df.observe(seen, *quality.row_totals(row_wise))
        observed.write.parquet(f"{path}/{folder}")
        written = read_parts(spark, path, df.schema, [folder])
        results = [judge_of(written, check) for check, judge_of in apart]
        if row_wise:
            totals = spark.createDataFrame([seen.get])
            results.append(quality.row_results(totals, row_wise))
        return reduce(DataFrame.unionByName, results).collect() if results else []

    row = quality.judged(spark, judge, checkpoint_name, table_name, run_time)
    if row.first().status == quality.PASSED:
        parts = dict(base.parts) | {f"{base.number + 1:012d}": folder}
        publish(spark, path, base, parts, {})
    return row


def read_checked(
    spark: SparkSession, path: str, schema: StructType | str, snapshot: Snapshot | None = None
) -> DataFrame:
    """The rows of all batches that passed."""
    found = snapshot or current(spark, path)
    return read_parts(spark, path, schema, list(found.parts.values()))
