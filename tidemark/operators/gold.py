"""Gold models: hourly rollup, latest value per symbol, trends."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import snap_round
from tidemark.functions.sentiment import hourly_category, trend
from tidemark.functions.times import column_type, hour_start, moment

TRENDS = ("reference", "previous_hour")


def hourly_sentiment(
    staged: DataFrame, as_of: str | datetime, time_col: str = "ingested_at"
) -> DataFrame:
    """Scored rows rolled up by hour and upper-cased symbol.

    One aggregation: rows are combined inside each task before the shuffle, so
    a symbol holding a third of the rows sends one partial row per task (and
    source, for the distinct count) and no more.
    """
    type_name = column_type(staged, time_col)
    score, price = F.col("sentiment_score"), F.col("price_usd")
    volume, change = F.col("volume_24h"), F.col("percent_change_24h")
    return (
        staged.filter(score.isNotNull())
        .groupBy(
            hour_start(F.col(time_col), type_name).alias("hour_timestamp"),
            F.upper("symbol").alias("symbol"),
        )
        .agg(
            snap_round(F.avg(score), 2).alias("avg_sentiment_score"),
            snap_round(F.min(score), 2).alias("min_sentiment_score"),
            snap_round(F.max(score), 2).alias("max_sentiment_score"),
            snap_round(F.stddev_samp(score), 2).alias("sentiment_stddev"),
            hourly_category(F.avg(score)).alias("sentiment_category"),
            snap_round(F.avg(price), 2).alias("avg_price_usd"),
            snap_round(F.min(price), 2).alias("min_price_usd"),
            snap_round(F.max(price), 2).alias("max_price_usd"),
            snap_round(F.avg(volume), 0).alias("avg_volume_24h"),
            snap_round(F.sum(volume), 0).alias("total_volume_24h"),
            snap_round(F.avg(change), 2).alias("avg_percent_change_24h"),
            F.count("*").alias("record_count"),
            F.count_distinct("source").alias("source_count"),
            F.max_by("sentiment_reasoning", F.struct(time_col, "id")).alias(
                "latest_reasoning"
            ),
        )
        .withColumn("aggregated_at", moment(as_of, type_name))
    )


def ordered_hourly(hourly: DataFrame) -> DataFrame:
    """Reading order of the hourly table; not applied before a write."""
    return hourly.orderBy(F.desc("hour_timestamp"), "symbol")


def _newest_first() -> Window:
    return Window.partitionBy("symbol").orderBy(F.desc("hour_timestamp"))


def _latest_columns(trend_word: Column) -> list[Column]:
    return [
        F.col("symbol"),
        F.col("hour_timestamp").alias("last_updated"),
        F.col("avg_sentiment_score").alias("sentiment_score"),
        F.col("sentiment_category"),
        trend_word.alias("sentiment_trend"),
        F.col("avg_price_usd").alias("price_usd"),
        F.col("avg_percent_change_24h").alias("percent_change_24h"),
        F.col("avg_volume_24h").alias("volume_24h"),
        F.col("record_count").alias("data_points"),
        F.col("latest_reasoning").alias("ai_reasoning"),
    ]


def latest_sentiment(hourly: DataFrame, trend_mode: str = "reference") -> DataFrame:
    """Newest hour of every symbol.

    ``reference`` compares within the rows that are left after ranking, one per
    symbol, so its trend is always STABLE. ``previous_hour`` compares the two
    newest hours. Both keep at most two hours per symbol and task before the
    shuffle.
    """
    if trend_mode not in TRENDS:
        raise ValueError(f"trend_mode must be one of {TRENDS}")
    keep = 1 if trend_mode == "reference" else 2
    ranked = hourly.withColumn("_rank", F.row_number().over(_newest_first())).filter(
        F.col("_rank") <= keep
    )
    score = F.col("avg_sentiment_score")
    if trend_mode == "reference":
        return ranked.select(*_latest_columns(trend(score, F.lit(None))))
    return (
        ranked.withColumn("_previous", F.lead(score).over(_newest_first()))
        .filter(F.col("_rank") == 1)
        .select(*_latest_columns(trend(score, F.col("_previous"))))
    )


def ordered_latest(latest: DataFrame) -> DataFrame:
    return latest.orderBy(F.desc("sentiment_score"), "symbol")


def trend_history(hourly: DataFrame) -> DataFrame:
    """Trend of every hour against the hour before it that has data."""
    over = Window.partitionBy("symbol").orderBy("hour_timestamp")
    previous = F.lag("avg_sentiment_score").over(over)
    return hourly.select(
        "symbol",
        "hour_timestamp",
        "avg_sentiment_score",
        previous.alias("prev_hour_sentiment"),
        trend(F.col("avg_sentiment_score"), previous).alias("sentiment_trend"),
    )


def trend_changes(hourly: DataFrame) -> DataFrame:
    """Hours whose trend differs from the trend of the hour before."""
    over = Window.partitionBy("symbol").orderBy("hour_timestamp")
    return (
        trend_history(hourly)
        .withColumn("previous_trend", F.lag("sentiment_trend").over(over))
        .filter(F.col("sentiment_trend") != F.col("previous_trend"))
    )
