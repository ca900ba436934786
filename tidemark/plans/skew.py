"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.storage import settle

SALTS = 32


def _broadcastable(df: DataFrame) -> bool:
    """Whether a written table's size is within the session's broadcast threshold."""
    session = df.sparkSession._jsparkSession.sessionState()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= session.conf().autoBroadcastJoinThreshold()


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: str,
    spread: Sequence[str],
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Join ``small`` (one row per key) to ``big``, however hot a key of ``big`` is.

    ``small`` is written out first, so the planner knows its true size: within
    the session's broadcast threshold ``big`` is joined where it is, without a
    shuffle. Beyond it every key is spread over ``salts`` tasks. The salt is a
    hash of the ``spread`` columns, so a re-run of a lost task sends rows where
    they went before.
    """
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    written = settle(small, "small-side")
    if _broadcastable(written):
        return big.join(F.broadcast(written), on, how)
    repeated = written.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    return big.withColumn("_salt", salt).join(repeated, [on, "_salt"], how).drop("_salt")


#: Rows of a piece that a task of costly row-wise work takes; some seconds of it.
PIECE_ROWS = 50_000


def spread(df: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Deal the rows of a table evenly to tasks of about ``piece_rows``.

    Files are split by bytes and row groups, which says little about the work
    behind a row: a compressed file of a million rows is one or two tasks. The
    rows should be moved before they grow wide. Their order is lost.
    """
    pieces = -(-df.count() // piece_rows)
    return df.repartition(pieces) if pieces > 1 else df
