"""Idempotent sinks of micro-batches.

Every batch of a run owns one folder of a table. A batch that is run again
after a failure overwrites its folder, so each row is in the table once. A run
is what one checkpoint keeps track of: another checkpoint numbers its batches
from 0 again, in folders of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

RUN, BATCH = "run_id", "batch_id"


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """Name of the run that a checkpoint keeps track of; later runs sort after it.

    Made of the file that Spark writes once, when the checkpoint is new: its
    time and the query id in it. A checkpoint that is moved must keep file times.
    """
    made = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").select(
        F.unix_millis("_metadata.file_modification_time").alias("at"),
        F.get_json_object("value", "$.id").alias("id"),
    )
    first = made.first()
    return f"r{first['at']}-{first['id']}"


def batch_folder(path: str, run: str, batch_id: int) -> str:
    return f"{path}/{RUN}={run}/{BATCH}={batch_id}"


def write_batch(df: DataFrame, path: str, run: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(batch_folder(path, run, batch_id))


def start(
    stream: DataFrame,
    handle: Callable[[DataFrame, str, int], None],
    checkpoint: str,
    mode: str = "append",
    available_now: bool = False,
) -> StreamingQuery:
    """Run ``handle`` on every micro-batch with the name of its run and its number.

    ``available_now`` stops once caught up.
    """

    def named(batch: DataFrame, batch_id: int) -> None:
        handle(batch, run_of(batch.sparkSession, checkpoint), batch_id)

    writer = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(named)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def keep_versions(
    stream: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Write the groups each batch changed; ``current_version`` reads the newest."""
    return start(
        stream,
        lambda df, run, batch_id: write_batch(df, path, run, batch_id),
        checkpoint,
        "update",
        available_now,
    )


def current_version(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The row last written for every key, by the latest run that has the key."""
    versions = spark.read.parquet(path)
    rest = [c for c in versions.columns if c not in (*keys, RUN, BATCH)]
    newest = F.max_by(F.struct(*rest), F.struct(RUN, BATCH)).alias("_row")
    return versions.groupBy(*keys).agg(newest).select(*keys, "_row.*")
