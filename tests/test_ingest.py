import base64
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import deadletter, ingest
from tidemark.sources import envelope, tables
from tidemark.sources.schemas import BROKER_RECORD, PUSH_ENVELOPE

AS_OF = "2024-01-01 12:00:00"


def push(ident, payload, attributes=None):
    data = payload if payload is None else base64.b64encode(payload.encode()).decode()
    return (ident, data, attributes, "2024-01-01T11:59:00")


@pytest.fixture
def pushed(frame):
    rows = [
        push("ok", '{"symbol": "btc", "percent_change_24h": 2.5, "price_usd": 10}', {"source": "feed"}),
        push("own", '{"symbol": "eth", "source": "inner"}', {"other": "x"}),
        push(None, '{"symbol": "no id"}'),
        ("empty", "", None, None),
        ("none", None, None, None),
        ("garbled", "@@@", None, None),
        ("bytes", base64.b64encode(b"\xff\xfe").decode(), None, None),
        push("broken", '{"symbol": '),
        push("list", "[1, 2]"),
        push("text", '"hello"'),
    ]
    return frame(rows, PUSH_ENVELOPE)


def test_every_message_is_accepted_or_rejected(pushed):
    result = ingest.ingest(pushed, AS_OF, "market-data")
    bronze = {r.id: r for r in result.bronze.collect()}
    dead = result.dead_letters.collect()
    assert len(bronze) + len(dead) == pushed.count()
    assert {r.error for r in dead} == {envelope.EMPTY, envelope.UNDECODABLE}
    assert bronze["ok"].source == "feed" and bronze["own"].source == "inner"
    assert (bronze["ok"].sentiment_score, bronze["own"].sentiment_score) == (7.5, None)
    unnamed = next(r for i, r in bronze.items() if i not in ("ok", "own"))
    assert len(unnamed.id) == 64 and unnamed.source == "unknown"


def test_named_by_content_the_same_on_a_replay(pushed):
    ids = [
        {r.message_id for r in envelope.decode_envelope(pushed).collect()} for _ in range(2)
    ]
    assert ids[0] == ids[1]


def test_metadata_and_vectors(pushed):
    result = ingest.ingest(pushed, AS_OF, "market-data")
    meta = json.loads(result.bronze.filter("id = 'ok'").first().processing_metadata)
    assert meta["pinecone_indexed"] is True and meta["function_version"] == "2.0.0"
    assert meta["pubsub_publish_time"] == "2024-01-01T11:59:00"
    vector = result.vectors.filter("id = 'ok'").first()
    assert vector.metadata.symbol == "BTC" and vector.metadata.sentiment_category == "BULLISH"


def test_unreadable_bytes_are_kept(frame):
    rows = [
        (b"k", b'{"id": "1"}', "t", 0, 1, None),
        (b"k", b"\xff\xfeA", "t", 0, 2, None),
        (b"k", b"[]", "t", 0, 3, None),
    ]
    decoded = envelope.decode_json(frame(rows, BROKER_RECORD)).withColumn("error", F.lit("e"))
    dead = deadletter.to_dead_letter(decoded.filter("payload is null"), "value", "t", AS_OF)
    kept = {r.original_message for r in dead.collect()}
    assert kept == {base64.b64encode(b"\xff\xfeA").decode(), "[]"}


def test_defaults_only_for_absent_keys(frame):
    payloads = [
        '{"id": "1", "symbol": "a"}',
        '{"id": "1", "symbol": "a", "price_usd": null, "source": null, "volume_24h": "7.5"}',
        '{"price_usd": 3}',
    ]
    rows = envelope.typed_message(frame([(p,) for p in payloads], "payload string"), AS_OF).collect()
    assert (rows[0].price_usd, rows[0].source, rows[0].news_headline) == (0.0, "unknown", None)
    assert rows[0].timestamp == "2024-01-01T12:00:00.000000"
    assert (rows[1].price_usd, rows[1].source, rows[1].volume_24h) == (None, None, 7.5)
    assert rows[2].error == "missing id, symbol"


def test_handler_verdicts(frame):
    df = frame([(1.0,), (-1.0,), (None,)], "price_usd double")
    accepted, refused = deadletter.handle(df, lambda d: d["price_usd"] > 0)
    assert accepted.count() == 1
    assert [r.error for r in refused.collect()] == [envelope.REFUSED] * 2


def test_redelivery_and_backoff(frame):
    df = frame([(i,) for i in range(1, 9)], "attempt int")
    retry, dead = deadletter.route_failures(df, AS_OF, max_attempts=8)
    waits = [(r.next_try - datetime(2024, 1, 1, 12)).total_seconds() for r in retry.orderBy("attempt").collect()]
    assert waits == [10, 20, 40, 80, 160, 320, 600]
    assert [r.attempt for r in dead.collect()] == [8]
    retry, dead = deadletter.route_failures(df, AS_OF)
    assert retry.count() == 2 and dead.count() == 6


def test_published_json_keeps_nulls(frame):
    df = frame([("a", None, 1.5)], "id string, headline string, price double")
    record = envelope.message_records(df, "id").first()
    assert record.key == "a" and json.loads(record.value) == {"id": "a", "headline": None, "price": 1.5}


def test_publish_to_files_and_read_as_stream(frame, spark, tmp_path):
    df = frame([("a", 1.5)], "id string, price double")
    path = str(tmp_path / "topic")
    envelope.publish(df, "market-data", "id", fmt="parquet", path=path)
    row = spark.read.parquet(path).first()
    assert (row.key, row.topic, json.loads(row.value)["price"]) == ("a", "market-data", 1.5)
    stream = envelope.read_messages(spark, "parquet", path=path)
    assert stream.isStreaming and stream.columns == BROKER_RECORD.names


def test_bronze_reads_only_needed_days(frame, spark, tmp_path):
    rows = [(str(d), "{}", "s", datetime(2024, 1, d), 5.0, "r", "{}") for d in range(1, 11)]
    schema = (
        "id string, raw_payload string, source string, ingested_at timestamp_ntz, "
        "sentiment_score double, sentiment_reasoning string, processing_metadata string"
    )
    path = str(tmp_path / "bronze")
    for _ in range(2):
        tables.write_bronze(frame(rows, schema), path)
    recent = tables.read_bronze(spark, path, "2024-01-10 00:00:00", 24)
    assert sorted(r.id for r in recent.collect()) == ["10", "10", "9", "9"]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan and "PushedFilters: [IsNotNull(ingested_at)" in plan
    assert tables.read_bronze(spark, path, AS_OF).count() == 20


def test_model_calls_leave_long_ids_alone(frame):
    from tidemark.operators.enrich import ask_model, embed_with_model

    ids = [(1 << 60) + 1, None, (1 << 60) + 3]
    df = frame([(i, "text") for i in ids], "acct long, text string")
    asked = ask_model(df, "text", lambda: lambda texts: ["1"] * len(texts))
    told = embed_with_model(df, "text", "v", lambda: lambda texts: [[1.0]] * len(texts))
    assert sorted([r.acct for r in asked.collect()], key=str) == sorted(ids, key=str)
    assert sorted([r.acct for r in told.collect()], key=str) == sorted(ids, key=str)
