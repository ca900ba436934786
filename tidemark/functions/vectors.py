"""Vector columns: cosine similarity and record metadata."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.numbers import SCORE_NEUTRAL
from tidemark.functions.sentiment import NEUTRAL, or_neutral, row_category
from tidemark.functions.text import HEADLINE_CHARS, REASONING_CHARS

# Metadata of a record that lacks it.
UNKNOWN_SYMBOL = "UNKNOWN"
UNKNOWN_SOURCE = "unknown"


def vector_metadata(
    symbol: Column,
    source: Column,
    score: Column,
    price: Column,
    change: Column,
    headline: Column,
    reasoning: Column,
    timestamp: Column,
) -> Column:
    """Metadata stored beside a vector, with the defaults of a missing field."""
    return F.struct(
        F.upper(F.coalesce(symbol, F.lit(UNKNOWN_SYMBOL))).alias("symbol"),
        F.coalesce(source, F.lit(UNKNOWN_SOURCE)).alias("source"),
        or_neutral(score).alias("sentiment_score"),
        row_category(score).alias("sentiment_category"),
        F.coalesce(price, F.lit(0.0)).alias("price_usd"),
        F.coalesce(change, F.lit(0.0)).alias("percent_change_24h"),
        F.substring(F.coalesce(headline, F.lit("")), 1, HEADLINE_CHARS).alias(
            "news_headline"
        ),
        F.substring(F.coalesce(reasoning, F.lit("")), 1, REASONING_CHARS).alias(
            "reasoning"
        ),
        timestamp.cast("string").alias("timestamp"),
    )


def match_columns() -> dict[str, Column]:
    """What a search returns of a match, missing metadata filled in."""
    meta = F.col("metadata")
    return {
        "symbol": F.coalesce(meta["symbol"], F.lit(UNKNOWN_SYMBOL)),
        "sentiment_score": F.coalesce(meta["sentiment_score"], F.lit(SCORE_NEUTRAL)),
        "sentiment_category": F.coalesce(meta["sentiment_category"], F.lit(NEUTRAL)),
        "price_usd": meta["price_usd"],
        "percent_change_24h": meta["percent_change_24h"],
        "news_headline": meta["news_headline"],
        "reasoning": meta["reasoning"],
        "timestamp": F.coalesce(meta["timestamp"], F.lit("")),
    }
