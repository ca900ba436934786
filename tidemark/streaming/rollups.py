"""Gold kept up to date from a stream.

The stream holds mergeable sums at the grain hour, symbol and source. That
splits a hot symbol's state over its sources, makes the distinct source count
exact without a growing set, and lets readers merge to the hourly table.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.numbers import snap_round
from tidemark.functions.sentiment import hourly_category
from tidemark.functions.times import moment
from tidemark.streaming.sinks import current_version, keep_versions

GRAIN = ["hour_timestamp", "symbol", "source"]


def partial_sums(staged: DataFrame, delay: str) -> DataFrame:
    """Sums of the scored rows by hour, symbol and source.

    ``staged`` is a stream or a table whose ``ingested_at`` is a TIMESTAMP.
    Rows later than ``delay`` behind the newest may be left out.
    """
    score, price = F.col("sentiment_score"), F.col("price_usd")
    volume, change = F.col("volume_24h"), F.col("percent_change_24h")
    order = F.struct("ingested_at", "id")
    last = F.struct(
        F.col("ingested_at").alias("at"), "id", F.col("sentiment_reasoning").alias("reasoning")
    )
    return (
        staged.filter(score.isNotNull())
        .withWatermark("ingested_at", delay)
        .groupBy(
            F.window("ingested_at", "1 hour").alias("_window"),
            F.upper("symbol").alias("symbol"),
            "source",
        )
        .agg(
            F.count("*").alias("n"),
            F.sum(score).alias("score_sum"),
            F.sum(score * score).alias("score_squares"),
            F.min(score).alias("score_min"),
            F.max(score).alias("score_max"),
            F.count(price).alias("price_n"),
            F.sum(price).alias("price_sum"),
            F.min(price).alias("price_min"),
            F.max(price).alias("price_max"),
            F.count(volume).alias("volume_n"),
            F.sum(volume).alias("volume_sum"),
            F.count(change).alias("change_n"),
            F.sum(change).alias("change_sum"),
            F.max_by(last, order).alias("last"),
        )
        .withColumn("hour_timestamp", F.col("_window.start"))
        .drop("_window")
    )


def merge_hourly(sums: DataFrame, as_of: str | datetime) -> DataFrame:
    """The hourly gold table from partial sums."""

    def total(name: str):
        return F.sum(name)

    def mean(name: str):
        return F.when(total(f"{name}_n") > 0, total(f"{name}_sum") / total(f"{name}_n"))

    n = total("n")
    average = total("score_sum") / n
    variance = F.greatest(
        F.lit(0.0),
        (total("score_squares") - total("score_sum") * total("score_sum") / n)
        / F.nullif(n - 1, F.lit(0)),
    )
    deviation = F.when(n > 1, F.sqrt(variance))
    return (
        sums.groupBy("hour_timestamp", "symbol")
        .agg(
            snap_round(average, 2).alias("avg_sentiment_score"),
            snap_round(F.min("score_min"), 2).alias("min_sentiment_score"),
            snap_round(F.max("score_max"), 2).alias("max_sentiment_score"),
            snap_round(deviation, 2).alias("sentiment_stddev"),
            hourly_category(average).alias("sentiment_category"),
            snap_round(mean("price"), 2).alias("avg_price_usd"),
            snap_round(F.min("price_min"), 2).alias("min_price_usd"),
            snap_round(F.max("price_max"), 2).alias("max_price_usd"),
            snap_round(mean("volume"), 0).alias("avg_volume_24h"),
            snap_round(total("volume_sum"), 0).alias("total_volume_24h"),
            snap_round(mean("change"), 2).alias("avg_percent_change_24h"),
            n.alias("record_count"),
            F.count("source").alias("source_count"),
            F.max("last").getField("reasoning").alias("latest_reasoning"),
        )
        .withColumn("aggregated_at", moment(as_of, "timestamp"))
    )


def run_hourly(
    staged: DataFrame, path: str, checkpoint: str, delay: str, available_now: bool = False
) -> StreamingQuery:
    """Maintain the partial sums of a stream under ``path``."""
    return keep_versions(partial_sums(staged, delay), path, checkpoint, available_now)


def read_hourly(spark: SparkSession, path: str, as_of: str | datetime) -> DataFrame:
    """The hourly gold table as the stream has it now."""
    return merge_hourly(current_version(spark, path, GRAIN), as_of)


def newest_messages(staged: DataFrame) -> DataFrame:
    """Newest message of every symbol; on a stream, to be kept as versions."""
    message = F.struct("id", "sentiment_score", "price_usd", "ingested_at")
    return (
        staged.groupBy(F.upper("symbol").alias("symbol"))
        .agg(F.max_by(message, F.struct("ingested_at", "id")).alias("_newest"))
        .select("symbol", "_newest.*")
    )


def drop_replays(stream: DataFrame, id_col: str, time_col: str, delay: str) -> DataFrame:
    """First delivery of every id; a repeat within ``delay`` of event time is dropped."""
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([id_col])
