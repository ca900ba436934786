"""Table layouts: writing and pruned reading of bronze, silver and gold.

Tables are partitioned by a derived date, since a folder per hour would be too
fine; readers name that date beside the time, so whole folders are skipped.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import column_type, hours_before
from tidemark.operators import gold, staging

INGEST_DATE = "ingest_date"
HOUR_DATE = "hour_date"


def write_bronze(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append bronze rows, clustered by source inside each file. No shuffle."""
    (
        df.withColumn(INGEST_DATE, F.to_date("ingested_at"))
        .sortWithinPartitions(INGEST_DATE, "source")
        .write.mode(mode)
        .partitionBy(INGEST_DATE)
        .parquet(path)
    )


def write_silver(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write silver rows, clustered by symbol inside each file. No shuffle."""
    (
        df.withColumn(INGEST_DATE, F.to_date("ingested_at"))
        .sortWithinPartitions(INGEST_DATE, "symbol")
        .write.mode(mode)
        .partitionBy(INGEST_DATE)
        .parquet(path)
    )


def write_gold_hourly(df: DataFrame, path: str) -> None:
    """Replace the hourly table; rebalancing sizes the files and splits a hot date."""
    (
        df.withColumn(HOUR_DATE, F.to_date("hour_timestamp"))
        .hint("rebalance", HOUR_DATE)
        .sortWithinPartitions(HOUR_DATE, "symbol")
        .write.mode("overwrite")
        .partitionBy(HOUR_DATE)
        .parquet(path)
    )


def read_since(
    spark: SparkSession,
    path: str,
    time_col: str,
    date_col: str,
    as_of: str | datetime,
    hours: int | None,
) -> DataFrame:
    """Rows of the last ``hours``; folders and row groups before them are skipped."""
    df = spark.read.parquet(path)
    if hours is None:
        return df.drop(date_col)
    bound = hours_before(as_of, hours, column_type(df, time_col))
    recent = df.filter(F.col(date_col) >= F.to_date(bound)).filter(
        F.col(time_col) >= bound
    )
    return recent.drop(date_col)


def read_bronze(
    spark: SparkSession, path: str, as_of: str | datetime, hours: int | None = None
) -> DataFrame:
    return read_since(spark, path, "ingested_at", INGEST_DATE, as_of, hours)


def read_gold_hourly(
    spark: SparkSession, path: str, as_of: str | datetime, hours: int | None = None
) -> DataFrame:
    return read_since(spark, path, "hour_timestamp", HOUR_DATE, as_of, hours)


def create_views(
    spark: SparkSession,
    bronze_path: str,
    hourly_path: str,
    as_of: str | datetime,
    hours: int | None = staging.LOOKBACK_HOURS,
    trend_mode: str = "reference",
) -> None:
    """Session views of staging and of the latest sentiment over written tables."""
    bronze = read_bronze(spark, bronze_path, as_of, hours)
    staged = staging.stage_market_data(bronze, as_of, hours)
    staged.createOrReplaceTempView("stg_market_data")
    hourly = read_gold_hourly(spark, hourly_path, as_of)
    hourly.createOrReplaceTempView("gold_hourly_sentiment")
    latest = gold.ordered_latest(gold.latest_sentiment(hourly, trend_mode))
    latest.createOrReplaceTempView("gold_latest_sentiment")
