"""Quantiles from stored sketches that merge, so that a day needs no second look at its events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import column_type, hour_start
from tidemark.operators.metrics import HISTOGRAM, attributes_key, registered

#: Size of a sketch; its rank error is below ``rank_error(K)``.
K = 400
HOUR = "hour"


def rank_error(k: int) -> float:
    """Rank error, as a share of all values, that a sketch of size ``k`` keeps to in 99
    of 100 cases (the bound its makers publish)."""
    return 2.296 / k**0.9021


def hourly_sketches(events: DataFrame, time_col: str = "ts", k: int = K) -> DataFrame:
    """(hour, name, attributes, n, sketch): one sketch per hour, histogram and attributes.

    Values are gathered into sketches inside the tasks; a key with a third of all
    events sends one sketch per task. Null and NaN values are left out and hours without any
    other have no row; events without a time are an hour of their own.
    """
    hour = hour_start(F.col(time_col), column_type(events, time_col)).alias(HOUR)
    usable = registered(events, HISTOGRAM).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    return usable.groupBy(hour, "name", attributes_key(F.col("attributes")).alias("attributes")).agg(
        F.count("*").alias("n"), F.kll_sketch_agg_double(F.col("value").cast("double"), k).alias("sketch")
    )


def merged(sketches: DataFrame, unit: str = "day") -> DataFrame:
    """The sketches of all hours of a ``unit`` (day, week, month) as one each."""
    start = F.date_trunc(unit, F.col(HOUR)).cast(column_type(sketches, HOUR)).alias(unit)
    return sketches.groupBy(start, "name", "attributes").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch")
    )


def quantiles(sketches: DataFrame, shares: Sequence[float]) -> DataFrame:
    """One row per sketch and share with the ``quantile`` at it."""
    wanted = F.array(*[F.lit(float(share)) for share in shares])
    found = F.kll_sketch_get_quantile_double("sketch", wanted)
    rows = sketches.withColumn("_at", F.explode(F.arrays_zip(wanted.alias("share"), found.alias("quantile"))))
    return rows.select(*[c for c in sketches.columns if c != "sketch"], "_at.share", "_at.quantile")


def observed_error(
    events: DataFrame, found: DataFrame, time_col: str = "ts", unit: str = "day"
) -> DataFrame:
    """``found`` with ``error``: how far each quantile's true ranks are from its share.

    A value that occurs often has a range of ranks; the error is the distance of the
    share from that range. All quantiles of a key are checked in one pass over its
    events: the few rows of ``found`` per key are put into one, counts are combined
    in the tasks.
    """
    keys = [unit, "name", "attributes"]
    start = F.date_trunc(unit, F.col(time_col)).cast(column_type(events, time_col)).alias(unit)
    values = registered(events, HISTOGRAM).select(
        start, "name", attributes_key(F.col("attributes")).alias("attributes"), "value"
    )
    asked = found.groupBy(*keys).agg(F.collect_list(F.struct("share", "quantile")).alias("asked"))
    paired = values.join(asked, keys).select(*keys, "value", F.explode("asked").alias("q"))
    counted = paired.groupBy(*keys, F.col("q.share").alias("share")).agg(
        F.count_if(F.col("value") < F.col("q.quantile")).alias("below"),
        F.count_if(F.col("value") <= F.col("q.quantile")).alias("up_to"),
    )
    low, high = F.col("below") / F.col("n"), F.col("up_to") / F.col("n")
    error = F.greatest(F.lit(0.0), low - F.col("share"), F.col("share") - high)
    return found.join(counted, [*keys, "share"]).withColumn("error", error).drop("below", "up_to")
