"""Latest values and changes of trend, told while the stream runs.

An hour is averaged as soon as the watermark has passed it, combined inside the
tasks first, so a symbol with a third of all rows sends one partial row per task.
What goes on from hour to hour is one small state per symbol.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.functions.numbers import snap_round
from tidemark.functions.sentiment import DECLINING, IMPROVING, STABLE
from tidemark.streaming.sinks import start, write_batch
from tidemark.streaming.stateful import start_stateful

TREND = (
    "symbol string, hour_timestamp timestamp, avg_sentiment_score double, "
    "prev_hour_sentiment double, sentiment_trend string, previous_trend string"
)
STATE = "score double, trend string"


def closed_hours(staged: DataFrame, delay: str) -> DataFrame:
    """(symbol, hour_timestamp, avg_sentiment_score) of hours that are over.

    ``staged`` is a stream whose ``ingested_at`` is a TIMESTAMP. An hour is over once
    a row has come that is ``delay`` later than its end; rows without a score count
    for the time alone, so heartbeats close the hours of symbols gone quiet.
    """
    score = F.col("sentiment_score")
    return (
        staged.select(F.upper("symbol").alias("symbol"), "sentiment_score", "ingested_at")
        .withWatermark("ingested_at", delay)
        .groupBy(F.window("ingested_at", "1 hour").alias("hour"), "symbol")
        .agg(F.count(score).alias("n"), snap_round(F.avg(score), 2).alias("average"))
        .filter("n > 0")
        .select("symbol", F.col("hour.start").alias("hour_timestamp"), "average")
    )


class _Trends(StatefulProcessor):
    """Compares every hour of a symbol with the one before that has data."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        hours = pd.concat(list(rows)).sort_values("hour_timestamp")
        score, trend = self.last.get() if self.last.exists() else (None, None)
        found = []
        for hour, average in zip(hours["hour_timestamp"], hours["average"]):
            word = STABLE
            if score is not None and average != score:
                word = IMPROVING if average > score else DECLINING
            found.append((key[0], hour, average, score, word, trend))
            score, trend = average, word
        self.last.update((score, trend))
        names = [column.split()[0] for column in TREND.split(", ")]
        yield pd.DataFrame(found, columns=names).astype({"prev_hour_sentiment": "float64"})

    def close(self) -> None:
        pass


def live_trends(staged: DataFrame, delay: str) -> DataFrame:
    """Every closed hour with its trend and the trend before, as a stream.

    The newest row of a symbol is its latest value. Hours close in their order, and
    several that close together are taken in order. Rows that come ``delay`` or more
    behind the newest may be left out. A null symbol is a symbol like others; equal
    averages are stable; the first hour of a symbol is stable with no trend before.
    """
    return closed_hours(staged, delay).groupBy("symbol").transformWithStateInPandas(
        _Trends(), TREND, "Append", "None"
    )


def changed(trends: DataFrame) -> DataFrame:
    """The hours whose trend differs from the hour before."""
    return trends.filter(F.col("sentiment_trend") != F.col("previous_trend"))


def run_trend_changes(
    staged: DataFrame, path: str, checkpoint: str, delay: str, available_now: bool = False
) -> StreamingQuery:
    """Write the ``latest`` hours and the ``changes`` of every batch under ``path``.

    A batch that is repeated after a failure replaces its own rows.
    """

    def handle(batch: DataFrame, run: str, batch_id: int) -> None:
        kept = batch.persist()
        try:
            write_batch(kept, f"{path}/latest", run, batch_id)
            write_batch(changed(kept), f"{path}/changes", run, batch_id)
        finally:
            kept.unpersist()

    return start_stateful(
        staged,
        lambda: start(live_trends(staged, delay), handle, checkpoint, available_now=available_now),
    )
