"""Serving queries over the gold tables: lookups, lists, history, market summary."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import SCORE_MAX, SCORE_MIN, SCORE_NEUTRAL, snap_round
from tidemark.functions.sentiment import BEARISH, BULLISH, NEUTRAL
from tidemark.functions.times import column_type, hours_before

# Allowed ranges of the request parameters.
BOUNDS = {
    "limit": (1, 100),
    "hours": (1, 168),
    "search_top_k": (1, 50),
    "similar_top_k": (1, 20),
    "query_length": (3, 500),
    "min_score": (0, 1),
}
# List sizes of the two summaries.
LIST_LIMIT = 50
SUMMARY_LIMIT = 100
TOP_LIST = 5

ANSWER_COLUMNS = [
    "symbol",
    "sentiment_score",
    "sentiment_category",
    "sentiment_trend",
    "price_usd",
    "percent_change_24h",
    "volume_24h",
    "data_points",
    "ai_reasoning",
    "last_updated",
]
HISTORY_COLUMNS = {
    "full": [
        "hour_timestamp",
        "symbol",
        "avg_sentiment_score",
        "sentiment_category",
        "avg_price_usd",
        "avg_percent_change_24h",
        "avg_volume_24h",
        "record_count",
    ],
    "brief": [
        "hour_timestamp",
        "symbol",
        "avg_sentiment_score",
        "sentiment_category",
        "avg_price_usd",
        "record_count",
    ],
}


def check_bounds(**params: float | None) -> None:
    """Refuse request parameters out of range; None means not given."""
    for name, value in params.items():
        low, high = BOUNDS[name]
        if value is not None and not low <= value <= high:
            raise ValueError(f"{name} must be between {low} and {high}, got {value}")


def symbol_sentiment(latest: DataFrame, symbol: str) -> DataFrame:
    """Latest row of one symbol, any letter case; no row when unknown.

    Gold symbols are upper-cased already, so comparing the bare column keeps
    the filter pushable to the scan.
    """
    return (
        latest.filter(F.col("symbol") == symbol.upper())
        .select(*ANSWER_COLUMNS)
        .limit(1)
    )


def list_sentiments(
    latest: DataFrame, limit: int = LIST_LIMIT, category: str | None = None
) -> DataFrame:
    """Best-scored symbols first, optionally of one category."""
    check_bounds(limit=limit)
    chosen = latest
    if category is not None:
        chosen = latest.filter(F.col("sentiment_category") == category)
    return (
        chosen.select(*ANSWER_COLUMNS)
        .orderBy(F.desc("sentiment_score"), "symbol")
        .limit(limit)
    )


def symbol_history(
    hourly: DataFrame,
    symbol: str,
    as_of: str | datetime,
    hours: int = 24,
    columns: str = "full",
) -> DataFrame:
    """Hours of one symbol within ``hours`` before ``as_of``, newest first."""
    check_bounds(hours=hours)
    bound = hours_before(as_of, hours, column_type(hourly, "hour_timestamp"))
    return (
        hourly.filter(F.col("symbol") == symbol.upper())
        .filter(F.col("hour_timestamp") >= bound)
        .select(*HISTORY_COLUMNS[columns])
        .orderBy(F.desc("hour_timestamp"))
    )


def history_payload(history: DataFrame) -> DataFrame:
    """History under the names of the answer document."""
    return history.select(
        F.col("hour_timestamp").alias("timestamp"),
        F.col("avg_sentiment_score").alias("sentiment_score"),
        "sentiment_category",
        F.col("avg_price_usd").alias("price_usd"),
        F.col("avg_percent_change_24h").alias("percent_change_24h"),
        F.col("avg_volume_24h").alias("volume_24h"),
        "record_count",
    )


def _counts() -> list:
    category = F.col("sentiment_category")
    return [
        F.count("*").alias("total_symbols"),
        F.count_if(category == BULLISH).alias("bullish_count"),
        F.count_if(category == NEUTRAL).alias("neutral_count"),
        F.count_if(category == BEARISH).alias("bearish_count"),
        F.max("last_updated").alias("last_updated"),
    ]


def market_summary(latest: DataFrame, limit: int = LIST_LIMIT) -> DataFrame:
    """One row: figures over the listed symbols, and the list itself.

    The list holds at most ``limit`` rows (100 by its bounds). No row when
    there is nothing to list.
    """
    score = F.col("sentiment_score")
    listed = list_sentiments(latest, limit)
    entry = F.struct((-score).alias("_order"), *ANSWER_COLUMNS)
    return (
        listed.agg(
            *_counts(),
            snap_round(F.avg(score), 2).alias("avg_market_sentiment"),
            F.array_sort(F.collect_list(entry)).alias("_entries"),
        )
        .filter(F.col("total_symbols") > 0)
        .withColumn(
            "symbols", F.transform("_entries", lambda e: e.dropFields("_order"))
        )
        .drop("_entries")
    )


def market_summary_top(latest: DataFrame, n: int = TOP_LIST) -> DataFrame:
    """One row: figures over at most 100 symbols with the most bullish and bearish.

    An empty table gives zeros, a neutral mean and empty lists.
    """
    score, category = F.col("sentiment_score"), F.col("sentiment_category")
    listed = list_sentiments(latest, SUMMARY_LIMIT)

    def top(wanted: str, order: F.Column) -> F.Column:
        entry = F.struct(order.alias("_order"), *ANSWER_COLUMNS)
        chosen = F.collect_list(F.when(category == wanted, entry))
        return F.transform(
            F.slice(F.array_sort(chosen), 1, n), lambda e: e.dropFields("_order")
        )

    return listed.agg(
        *_counts(),
        F.coalesce(snap_round(F.avg(score), 2), F.lit(SCORE_NEUTRAL)).alias(
            "avg_market_sentiment"
        ),
        top(BULLISH, -score).alias("top_bullish"),
        top(BEARISH, score).alias("top_bearish"),
    )


def top_per_category(latest: DataFrame, n: int = TOP_LIST) -> DataFrame:
    """The same top lists as rows: best bullish first, worst bearish first."""
    score, category = F.col("sentiment_score"), F.col("sentiment_category")
    outward = F.when(category == BULLISH, -score).otherwise(score)
    rank = F.row_number().over(
        Window.partitionBy("sentiment_category").orderBy(outward, "symbol")
    )
    return (
        list_sentiments(latest, SUMMARY_LIMIT)
        .filter(category.isin(BULLISH, BEARISH))
        .withColumn("position", rank)
        .filter(F.col("position") <= n)
        .select("sentiment_category", "position", "symbol", "sentiment_score")
    )


def response_violations(answer: DataFrame) -> DataFrame:
    """Rows that break the answer contract: score in range, mandatory fields present."""
    missing = F.lit(False)
    for name in (
        "symbol",
        "sentiment_score",
        "sentiment_category",
        "data_points",
        "last_updated",
    ):
        missing = missing | F.col(name).isNull()
    return answer.filter(
        missing | ~F.col("sentiment_score").between(SCORE_MIN, SCORE_MAX)
    )


def assert_response(answer: DataFrame) -> DataFrame:
    """The answer itself, failing the job on the first row that breaks the contract."""
    score = F.col("sentiment_score")
    checked = F.when(
        score.between(SCORE_MIN, SCORE_MAX) & F.col("data_points").isNotNull(), score
    ).otherwise(F.raise_error(F.lit("answer breaks the response contract")))
    return answer.withColumn("sentiment_score", checked)
