"""Streams against batch, restarts, and repeated batches."""

from datetime import datetime, timedelta
from functools import partial

import pytest
from pyspark.sql import functions as F

from tidemark.operators.gold import hourly_sentiment
from tidemark.plans.skew import spread
from tidemark.sources.schemas import PUSH_ENVELOPE
from tidemark.streaming import rollups, sinks
from tidemark.streaming.ingest import run_ingest
from workload import adapters, messages, streams
from workload.adapters import table

COMPARED = [
    "hour_timestamp", "symbol", "avg_sentiment_score", "sentiment_stddev",
    "record_count", "source_count", "latest_reasoning", "total_volume_24h",
]


def rows_of(df, columns):
    return sorted(map(repr, df.select(*columns).collect()))


def test_merged_sums_equal_the_batch_rollup(spark, small):
    staged = (
        adapters.staged_columns(table(spark, small, "events"))
        .filter("symbol is not null")
        .withColumn("ingested_at", F.col("ingested_at").cast("timestamp"))
    )
    as_of = "2024-02-01 00:00:00"
    merged = rollups.merge_hourly(rollups.partial_sums(staged, "1 hour"), as_of)
    assert rows_of(merged, COMPARED) == rows_of(hourly_sentiment(staged, as_of), COMPARED)


def test_repeated_batch_replaces_itself(frame, spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_batch(frame([(1,), (2,)], "a int"), path, "r1", 0)
    sinks.write_batch(frame([(3,)], "a int"), path, "r1", 1)
    sinks.write_batch(frame([(1,), (2,)], "a int"), path, "r1", 0)
    assert sorted(r.a for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_a_new_checkpoint_keeps_what_another_has_written(frame, spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run(checkpoint: str) -> None:
        stream = spark.readStream.schema("a long").parquet(source)
        state = str(tmp_path / checkpoint)

        def handle(batch, run, batch_id):
            sinks.write_batch(batch, out, run, batch_id)

        query = sinks.start(stream, handle, state, available_now=True)
        query.awaitTermination()

    frame([(1,), (2,)], "a long").write.parquet(source)
    run("first")
    frame([(3,)], "a long").write.mode("append").parquet(source)
    run("first")
    run("second")
    assert sorted(r.a for r in spark.read.parquet(out).collect()) == [1, 1, 2, 2, 3, 3]


def test_the_latest_run_counts(frame, spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_batch(frame([("a", 1)], "k string, n int"), path, "r1", 5)
    sinks.write_batch(frame([("a", 2)], "k string, n int"), path, "r2", 0)
    assert [r.n for r in sinks.current_version(spark, path, ["k"]).collect()] == [2]


def test_current_version_is_the_last_batch(frame, spark, tmp_path):
    path = str(tmp_path / "out")
    schema = "k string, n int, note string"
    sinks.write_batch(frame([("a", 1, "x"), ("b", 1, None)], schema), path, "r1", 0)
    sinks.write_batch(frame([("a", 2, None)], schema), path, "r1", 1)
    got = {tuple(r) for r in sinks.current_version(spark, path, ["k"]).collect()}
    assert got == {("a", 2, None), ("b", 1, None)}


def test_ingest_survives_a_failed_batch(frame, spark, tmp_path):
    """A scorer that fails on its first batch; the restart must lose and repeat nothing."""
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = [(str(i), "eyJzeW1ib2wiOiAiYnRjIn0=", None, None) for i in range(20)] + [("x", "", None, None)]
    frame(rows, PUSH_ENVELOPE).write.parquet(source)
    stream = spark.readStream.schema(PUSH_ENVELOPE).parquet(source)

    def failing(df):
        raise RuntimeError("model down")

    def working(df):
        return df.withColumns({"score": F.lit(5.0), "reasoning": F.lit("r")})

    with pytest.raises(Exception, match="model down"):
        query = run_ingest(stream, out, state, "t", "2024-01-01", score=failing, available_now=True)
        query.awaitTermination()
    for _ in range(2):
        run_ingest(stream, out, state, "t", "2024-01-01", score=working, available_now=True).awaitTermination()
    assert spark.read.parquet(f"{out}/bronze").count() == 20
    assert spark.read.parquet(f"{out}/vectors").count() == 20
    assert spark.read.parquet(f"{out}/dead_letters").count() == 1


def test_rollup_over_restarts_equals_batch(spark, small):
    stream = streams.hourly_stream(spark, small)
    events = table(spark, small, "events")
    staged = adapters.staged_columns(events).filter("symbol is not null")
    assert rows_of(stream, COMPARED) == rows_of(hourly_sentiment(staged, "2024-01-31"), COMPARED)


def test_replays_within_the_delay_are_dropped(frame, spark, tmp_path):
    source = str(tmp_path / "in")
    start = datetime(2024, 1, 1)
    schema = "id string, ts timestamp"
    frame([("a", start), ("a", start + timedelta(minutes=5)), ("b", start)], schema).write.parquet(source)
    stream = spark.readStream.schema(schema).parquet(source)
    out = streams.scratch_path(spark, "test")
    query = (
        rollups.drop_replays(stream, "id", "ts", "1 hour")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", streams.scratch_path(spark, "test"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_costly_rows_are_dealt_to_many_tasks(spark, small, tmp_path, monkeypatch):
    """A table in one small file must not be scored and embedded by one task."""
    few = partial(spread, piece_rows=100)
    seen, ingest = [], messages.ingest.ingest
    for module in (messages, streams):
        monkeypatch.setattr(module, "spread", few, raising=False)
    monkeypatch.setattr(streams, "scratch_path", lambda spark, label: f"{tmp_path}/{label}")
    monkeypatch.setattr(
        messages.ingest, "ingest", lambda pushed, *rest: seen.append(pushed) or ingest(pushed, *rest)
    )
    batch = messages.ingest_bronze(spark, small)
    pieces = -(-table(spark, small, "events").count() // 100)
    assert pieces > 1 and seen[0].rdd.getNumPartitions() == pieces
    stream = streams.ingest_stream(spark, small)
    for step in range(streams.STEPS):
        assert len(list(tmp_path.glob(f"replay/step={step}/*.parquet"))) > 1
    assert rows_of(stream, batch.columns) == rows_of(batch, batch.columns)
