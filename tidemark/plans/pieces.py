"""Order-dependent work split by range instead of by key.

Grouping by key puts a hot key into one task. Here rows are range-partitioned
by key *and* order, so a hot key spreads over many pieces of like size, and
what one piece needs to know of those before it is a small summary.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.storage import settle

PIECE = "_piece"


def range_pieces(
    df: DataFrame, order: Sequence[str], pieces: int | None = None
) -> DataFrame:
    """``df`` with a piece number; pieces are contiguous in ``order``.

    ``order`` should name rows uniquely, so that any run of equal keys can be
    cut. The result is written out: range bounds are sampled, and a re-run
    after a lost executor must not cut elsewhere.
    """
    spark = df.sparkSession
    count = pieces or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(count, *order)
    return settle(ranged.withColumn(PIECE, F.spark_partition_id()), "pieces")


def running_sum(
    df: DataFrame,
    value: str,
    order: Sequence[str],
    by: Sequence[str] = (),
    pieces: int | None = None,
) -> DataFrame:
    """Add ``running``: the sum of ``value`` from the first row up to this one.

    Each piece sums its own rows; the sums of the pieces before it, one row per
    piece and key, give the offset. ``value`` should be exact (whole or decimal).
    A null value adds nothing, and null keys are a group like any other.
    """
    cut = range_pieces(df, [*by, *order], pieces)
    groups = [*by, PIECE]
    totals = cut.groupBy(*groups).agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*by).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset")
    names = {column: f"_of_{i}" for i, column in enumerate(groups)}
    offsets = totals.select(*[F.col(c).alias(n) for c, n in names.items()], offset)
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()])
    within = Window.partitionBy(*groups).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        cut.withColumn("_inside", F.coalesce(F.sum(value).over(within), F.lit(0)))
        .join(offsets, same)
        .withColumn("running", F.col("_inside") + F.col("_offset"))
        .drop("_inside", "_offset", PIECE, *names.values())
    )


def with_previous(
    df: DataFrame,
    value: str,
    order: Sequence[str],
    by: Sequence[str] = (),
    pieces: int | None = None,
) -> DataFrame:
    """Add ``previous``: the ``value`` of the row before in ``order``, null for the first.

    A piece looks back within itself; its first row of a key takes the last value of
    the pieces before, which is one row per piece and key. Null keys are a group like
    any other; a null value is handed on as null.
    """
    cut = range_pieces(df, [*by, *order], pieces)
    groups = [*by, PIECE]
    place = F.struct(*order)
    lasts = cut.groupBy(*groups).agg(F.max_by(F.struct(value), place).alias("_last"))
    before = Window.partitionBy(*by).orderBy(PIECE)
    names = {column: f"_of_{i}" for i, column in enumerate(groups)}
    handed = lasts.select(
        *[F.col(c).alias(n) for c, n in names.items()], F.lag("_last").over(before).alias("_before")
    )
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()])
    within = Window.partitionBy(*groups).orderBy(*order)
    return (
        cut.withColumn("_lag", F.lag(F.struct(value)).over(within))
        .join(handed, same)
        .withColumn("previous", F.coalesce("_lag", "_before").getField(value))
        .drop("_lag", "_before", PIECE, *names.values())
    )
