"""Rollups of metric events: counters, histograms, levels, errors, latencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.pieces import running_sum

COUNTER, HISTOGRAM, UP_DOWN = "counter", "histogram", "up_down_counter"

# Registered metrics and their kinds.
REGISTERED = {
    "request_count": COUNTER,
    "request_latency": HISTOGRAM,
    "messages_processed": COUNTER,
    "processing_latency": HISTOGRAM,
    "sentiment_score": HISTOGRAM,
    "sentiment_requests": COUNTER,
    "errors": COUNTER,
    "bigquery_latency": HISTOGRAM,
    "bigquery_rows": COUNTER,
    "pinecone_latency": HISTOGRAM,
    "pinecone_vectors": COUNTER,
    "active_connections": UP_DOWN,
}


def registered(events: DataFrame, kind: str) -> DataFrame:
    """Events of the registered metrics of one kind; others are ignored."""
    names = [name for name, own in REGISTERED.items() if own == kind]
    return events.filter(F.col("name").isin(names))


def ignored_metrics(events: DataFrame) -> DataFrame:
    """Events of unregistered metrics, counted by name."""
    return (
        events.filter(~F.col("name").isin(list(REGISTERED)))
        .groupBy("name")
        .agg(F.count("*").alias("ignored"))
    )


def attributes_key(attributes: Column) -> Column:
    """A map as JSON text with sorted keys: equal maps give equal text."""
    entries = F.array_sort(F.map_entries(F.coalesce(attributes, F.create_map().cast("map<string,string>"))))
    return F.to_json(F.map_from_entries(entries))


def counter_rollup(events: DataFrame) -> DataFrame:
    """Sum per counter and attributes (columns name, attributes, value)."""
    return (
        registered(events, COUNTER)
        .groupBy("name", attributes_key(F.col("attributes")).alias("attributes"))
        .agg(
            F.sum(F.col("value").cast("decimal(38,9)")).cast("double").alias("total"),
            F.count("*").alias("events"),
        )
    )


def histogram_rollup(events: DataFrame, bounds: Sequence[float]) -> DataFrame:
    """Count, sum, extremes and bucket counts per histogram and attributes.

    Bucket i counts values above bound i - 1 and up to bound i; the last one
    counts values above all bounds.
    """
    value = F.col("value")
    limits = sorted(bounds)
    lows: list[float | None] = [None, *limits]
    highs: list[float | None] = [*limits, None]

    def inside(low: float | None, high: float | None) -> Column:
        above = F.lit(True) if low is None else value > low
        return above if high is None else above & (value <= high)

    buckets = [F.count_if(inside(low, high)) for low, high in zip(lows, highs)]
    return (
        registered(events, HISTOGRAM)
        .groupBy("name", attributes_key(F.col("attributes")).alias("attributes"))
        .agg(
            F.count(value).alias("count"),
            F.sum(value.cast("decimal(38,9)")).cast("double").alias("sum"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            F.array(*buckets).alias("buckets"),
        )
    )


def running_level(
    events: DataFrame, order: Sequence[str], by: Sequence[str] = ("name",)
) -> DataFrame:
    """Up/down counters as a level over time: the sum of all changes so far."""
    return running_sum(registered(events, UP_DOWN), "value", order, by).withColumnRenamed(
        "running", "level"
    )


def error_rollup(errors: DataFrame) -> DataFrame:
    """Errors by type, service and operation."""
    return errors.groupBy("error_type", "service", "operation").agg(
        F.count("*").alias("errors")
    )


def latency_ms(spans: DataFrame, start: str = "start_ts", end: str = "end_ts") -> DataFrame:
    """Add the elapsed milliseconds of every call."""
    micros = F.unix_micros(F.col(end).cast("timestamp")) - F.unix_micros(
        F.col(start).cast("timestamp")
    )
    return spans.withColumn("latency_ms", micros / 1000.0)
