"""The hourly table kept up to date: only dates with new bronze rows are rolled up again."""

from __future__ import annotations

import json
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators import gold, staging
from tidemark.sources import snapshots
from tidemark.sources.tables import HOUR_DATE, INGEST_DATE

#: Part of the rows without a time.
UNDATED = "undated"
_MARK, _SCHEMA = "mark:", "schema"


def date_marks(spark: SparkSession, bronze_path: str) -> dict[str, str]:
    """A mark per bronze date that changes with the names, sizes and times of its files.

    Files are listed, not read. One row per date comes to the driver.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .load(bronze_path)
        .select(
            F.coalesce(F.col(INGEST_DATE).cast("string"), F.lit(UNDATED)).alias("day"),
            F.xxhash64("path", "length", "modificationTime").alias("file"),
        )
    )
    marks = files.groupBy("day").agg(F.count("*").alias("n"), F.bit_xor("file").alias("all"))
    return {row["day"]: f"{row['n']}-{row['all']}" for row in marks.collect()}


def _of_days(df: DataFrame, column: str, days: list[str]) -> DataFrame:
    """Rows of some dates, by a filter that skips the folders of all others."""
    named = F.col(column).isin([date.fromisoformat(day) for day in days if day != UNDATED])
    return df.filter(named | F.col(column).isNull() if UNDATED in days else named)


def refresh_hourly(
    spark: SparkSession, bronze_path: str, path: str, as_of: str | datetime
) -> list[str]:
    """Bring the hourly table under ``path`` up to date with bronze; gives the dates redone.

    A date whose bronze files are others than at its last refresh is staged and
    rolled up again as a whole, so late rows, repeated rows and deleted files count
    as in a full refresh. Dates without bronze files leave the table. All other
    folders stay as they are, with the ``aggregated_at`` of their own refresh. The
    list of folders is swapped last: readers never see half a refresh, a crash
    changes nothing, and ``snapshots.Conflict`` tells that another was faster.

    Files are listed before they are read. Rows that arrive between are in the
    result already, and their date is redone by the next call. Rows without a time
    are a part of their own; dates whose rows hold no score have no folder.
    """
    base = snapshots.current(spark, path)
    before = {k.removeprefix(_MARK): v for k, v in base.notes.items() if k.startswith(_MARK)}
    marks = date_marks(spark, bronze_path)
    changed = sorted(day for day, mark in marks.items() if before.get(day) != mark)
    redone = sorted({*changed, *(before.keys() - marks.keys())})
    if not redone:
        return []
    parts = {day: folder for day, folder in base.parts.items() if day not in redone}
    schema = base.notes.get(_SCHEMA)
    if changed:
        bronze = _of_days(spark.read.parquet(bronze_path), INGEST_DATE, changed).drop(INGEST_DATE)
        hourly = gold.hourly_sentiment(staging.stage_market_data(bronze, as_of, None), as_of)
        schema = hourly.schema.json()
        folder = snapshots.new_folder(path)
        (
            hourly.withColumn(HOUR_DATE, F.to_date("hour_timestamp"))
            .hint("rebalance", HOUR_DATE)
            .sortWithinPartitions(HOUR_DATE, "symbol")
            .write.partitionBy(HOUR_DATE)
            .parquet(f"{path}/{folder}")
        )
        for name in snapshots.names_in(spark, f"{path}/{folder}"):
            day = name.removeprefix(f"{HOUR_DATE}=")
            if day != name:
                parts[day if day in marks else UNDATED] = f"{folder}/{name}"
    notes = {_MARK + day: mark for day, mark in marks.items()} | {_SCHEMA: schema}
    snapshots.publish(spark, path, base, parts, notes)
    return redone


def read_hourly(
    spark: SparkSession,
    path: str,
    first_day: str | None = None,
    snapshot: snapshots.Snapshot | None = None,
) -> DataFrame:
    """The hourly table, or its dates from ``first_day`` on; other folders are not listed.

    A table that was never refreshed is an error. ``first_day`` leaves out rows without a time.
    """
    found = snapshot or snapshots.current(spark, path)
    if _SCHEMA not in found.notes:
        raise ValueError(f"no hourly table at {path}")
    days = [day for day in sorted(found.parts) if not first_day or first_day <= day < UNDATED]
    folders = [found.parts[day] for day in days]
    schema = StructType.fromJson(json.loads(found.notes[_SCHEMA]))
    return snapshots.read_parts(spark, path, schema, folders)
