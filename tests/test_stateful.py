"""Streams with state of their own: live trends and redelivery."""

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import gold
from tidemark.sources.envelope import REFUSED
from tidemark.streaming import redelivery, sinks, trends
from tidemark.streaming.stateful import PROVIDER

START = datetime(2024, 1, 1)
STAGED = (
    "id string, symbol string, sentiment_score double, ingested_at timestamp, price_usd double, "
    "volume_24h double, percent_change_24h double, source string, sentiment_reasoning string"
)


def _staged(frame, rows):
    """(minute, symbol, score) as staged rows."""
    return frame(
        [
            (str(i), symbol, score, START + timedelta(minutes=m), 1.0, 1.0, 1.0, "s", "r")
            for i, (m, symbol, score) in enumerate(rows)
        ],
        STAGED,
    )


class _Feed:
    """A folder that a stream reads, filled step by step; each run is a restart."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, path, schema
        self.out, self.state, self.steps = f"{path}/out", f"{path}/state", 0

    def add(self, df):
        df.write.parquet(f"{self.path}/in/step={self.steps}")
        self.steps += 1

    def stream(self):
        return self.spark.readStream.schema(self.schema).parquet(f"{self.path}/in/step=*")

    def written(self, name):
        return self.spark.read.parquet(f"{self.out}/{name}").drop(sinks.RUN, sinks.BATCH)


# Two symbols that rise, fall and stay, one without a name and one that falls silent.
ROWS = [
    (60 * hour + 7 * i, symbol, float(3 + (hour * step) % 5 + i) if (hour + step) % 4 else 5.0)
    for hour in range(12)
    for step, symbol in enumerate(("btc", "Eth", None, "gone"))
    for i in range(3)
    if symbol != "gone" or hour < 4
] + [(35, "none", None), (3 * 60, "btc", None)]


def _run_trends(feed):
    query = trends.run_trend_changes(feed.stream(), feed.out, feed.state, "30 minutes", True)
    query.awaitTermination()


def test_trend_changes_are_told_while_the_stream_runs(spark, frame, tmp_path):
    feed = _Feed(spark, str(tmp_path), STAGED)
    rows = _staged(frame, ROWS)
    whole = gold.trend_changes(gold.hourly_sentiment(rows, "2024-02-01 00:00:00"))
    want = {(r.symbol, r.hour_timestamp, r.sentiment_trend, r.previous_trend) for r in whole.collect()}

    def told():
        found = feed.written("changes").collect()
        assert len(found) == len(set(found))
        return {(r.symbol, r.hour_timestamp, r.sentiment_trend, r.previous_trend) for r in found}

    noon = F.lit(START + timedelta(hours=6))
    feed.add(rows.filter(F.col("ingested_at") < noon))
    _run_trends(feed)
    # The newest row is of 05:14, so the hours up to 04:00 are told before the rest has come.
    early = {row for row in want if row[1] < START + timedelta(hours=4)}
    assert early and told() == early
    feed.add(rows.filter(F.col("ingested_at") >= noon))
    _run_trends(feed)
    feed.add(_staged(frame, [(20 * 60, None, None)]))
    _run_trends(feed)
    assert told() == want
    latest = feed.written("latest")
    newest = latest.groupBy("symbol").agg(F.max_by("avg_sentiment_score", "hour_timestamp").alias("s"))
    hourly = gold.hourly_sentiment(rows, "2024-02-01 00:00:00")
    assert {(r.symbol, r.s) for r in newest.collect()} == {
        (r.symbol, r.sentiment_score) for r in gold.latest_sentiment(hourly).collect()
    }


def test_a_stream_without_rows_tells_nothing(spark, frame, tmp_path):
    feed = _Feed(spark, str(tmp_path), STAGED)
    feed.add(_staged(frame, []))
    _run_trends(feed)
    feed.add(_staged(frame, [(0, "btc", None), (600, None, None)]))
    _run_trends(feed)
    assert feed.written("changes").count() == feed.written("latest").count() == 0


def test_the_session_keeps_its_state_store(spark, frame, tmp_path):
    before = spark.conf.get(PROVIDER, None)
    feed = _Feed(spark, str(tmp_path), STAGED)
    feed.add(_staged(frame, [(0, "btc", 5.0)]))
    _run_trends(feed)
    assert spark.conf.get(PROVIDER, None) == before


MESSAGE = "id string, message string, at timestamp"


def _handlers():
    """Makes handlers; messages say how many attempts fail, and whether by raising.

    Made inside, so that it is sent to the workers and not looked up there.
    """

    def make():
        def accepts(ident, message, attempt):
            failures, how = message.split(":")
            if attempt <= int(failures) and how == "raise":
                raise ValueError(f"no {ident} at {attempt}")
            return attempt > int(failures)

        return accepts

    return make


def _plain(messages, limit=3):
    """Every attempt on every message, worked out one by one."""
    found = []
    for ident, message, at in messages:
        failures, how = message.split(":")
        for attempt in range(1, limit + 1):
            failed = attempt <= int(failures)
            last = attempt == limit
            due = at + timedelta(seconds=redelivery.wait_seconds(attempt))
            error = (f"no {ident} at {attempt}" if how == "raise" else REFUSED) if failed else None
            outcome = "done" if not failed else "dead" if last else "retry"
            found.append((ident, attempt, at, outcome, due if outcome == "retry" else None, error))
            if not failed:
                break
            at = due
    return sorted(found, key=repr)


def _run_redelivery(feed, limit=3):
    redelivery.run_redelivery(
        feed.stream(), feed.out, feed.state, _handlers(), "raw", "10 seconds", limit, available_now=True
    ).awaitTermination()


def _tried(feed):
    rows = feed.written("attempts").filter("id IS NULL OR id <> 'beat'").collect()
    return sorted(((r.id, r.attempt, r.at, r.outcome, r.next_try, r.error) for r in rows), key=repr)


@pytest.mark.parametrize("limit", [3, 5])
def test_failed_messages_come_back_over_restarts(spark, frame, tmp_path, limit):
    feed = _Feed(spark, str(tmp_path), MESSAGE)
    moment = START + timedelta(microseconds=123_456)
    messages = [
        (f"m{i}", f"{i % 7}:{'raise' if i % 2 else 'refuse'}", moment + timedelta(seconds=3 * i))
        for i in range(40)
    ]
    # Repeats, among them of a message without id, are handled each on its own.
    messages += [messages[5], (None, "2:refuse", moment), (None, "2:refuse", moment)]
    feed.add(frame(messages[:20], MESSAGE))
    _run_redelivery(feed, limit)
    assert not any(row[3] == "dead" and row[0] == "m19" for row in _tried(feed))
    late = [m for m in messages[20:40]]
    feed.add(frame(late, MESSAGE))
    _run_redelivery(feed, limit)
    # What came long ago would be late by now, so the repeats come with their own time.
    again = [(i, m, moment + timedelta(seconds=200)) for i, m, _ in messages[40:]]
    feed.add(frame(again + [("beat", "0:refuse", START + timedelta(hours=2))], MESSAGE))
    _run_redelivery(feed, limit)
    want = messages[:40] + again
    assert _tried(feed) == _plain(want, limit)
    letters = feed.written("dead_letters").collect()
    dead = [row for row in _plain(want, limit) if row[3] == "dead"]
    assert sorted(r.error for r in letters) == sorted(row[5] for row in dead)
    assert {r.topic for r in letters} == {"raw"} and all(":" in r.original_message for r in letters)


def test_waits_double_within_bounds():
    assert [redelivery.wait_seconds(n) for n in (1, 2, 3, 6, 7, 50)] == [10, 20, 40, 320, 600, 600]


def test_the_clock_may_count_instead(spark, frame, tmp_path):
    feed = _Feed(spark, str(tmp_path), MESSAGE)
    feed.add(frame([("a", "0:refuse", START), ("b", "9:raise", None)], MESSAGE))

    def run(available_now):
        where = (feed.stream(), feed.out, feed.state, _handlers(), "raw", "10 seconds")
        return redelivery.run_redelivery(*where, 1, "ProcessingTime", available_now)

    with pytest.raises(ValueError, match="caught up"):
        run(True)
    query, until = run(False), time.time() + 90
    try:
        while time.time() < until and query.isActive and not any(p["numInputRows"] for p in query.recentProgress):
            time.sleep(0.5)
    finally:
        query.stop()
    rows = {r.id: r for r in feed.written("attempts").collect()}
    assert rows["a"].outcome == "done" and rows["b"].outcome == "dead" and rows["b"].error == "no b at 1"
    assert rows["a"].at > START + timedelta(days=300)
    with pytest.raises(ValueError):
        redelivery.attempts(feed.stream(), _handlers(), "1 second", time_mode="other")
