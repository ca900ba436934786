"""Queries answered by a stream over the events, replayed in order of time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import sentiment
from tidemark.functions.times import iso_text
from tidemark.operators import gold, routing, staging
from tidemark.plans.skew import spread
from tidemark.plans.storage import scratch_path
from tidemark.streaming import redelivery, rollups, sinks, trends
from tidemark.streaming.ingest import run_ingest
from tidemark.streaming.limiter import run_rate_limit
from workload import adapters, live, market, messages, sql
from workload.adapters import table

# Spread of the test events, so that no replayed row counts as late.
DELAY = "60 days"
STEPS = 2
# Steps are replayed in order of time, so hours can be closed soon after their end.
SHORT_DELAY = "1 hour"
HEARTBEAT = "heartbeat"


def replay(
    events: DataFrame,
    run: Callable[[DataFrame], StreamingQuery],
    time_col: str = "ts",
    steps: int = STEPS,
    costly: bool = False,
) -> None:
    """Feed all events to a stream in steps of time; each step is taken up by a
    restarted query, which must go on from its checkpoint. For work that is
    ``costly`` row by row, rows are dealt to as many files as tasks should share it."""
    spark = events.sparkSession
    path = scratch_path(spark, "replay")
    timed = events.withColumn(time_col, F.col(time_col).cast("timestamp"))
    first, last = timed.agg(F.min(time_col), F.max(time_col)).first()
    width = (last - first) / steps
    for step in range(steps):
        part = timed.filter(F.col(time_col) >= F.lit(first + step * width))
        if step < steps - 1:
            part = part.filter(F.col(time_col) < F.lit(first + (step + 1) * width))
        part = spread(part) if costly else part
        part.write.parquet(f"{path}/step={step}")
        stream = spark.readStream.schema(timed.schema).parquet(f"{path}/step=*")
        run(stream).awaitTermination()


def _appended(
    events: DataFrame, build: Callable[[DataFrame], DataFrame], label: str
) -> DataFrame:
    """Rows of an append-mode stream over the events, written as files and read back."""
    spark = events.sparkSession
    out, state = scratch_path(spark, label), scratch_path(spark, "state")

    def run(stream: DataFrame) -> StreamingQuery:
        return (
            build(stream)
            .writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", state)
            .trigger(availableNow=True)
            .start()
        )

    replay(events, run)
    return spark.read.parquet(out)


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    as_of = adapters.as_of(spark, sf_dir)
    out, state = scratch_path(spark, "hourly"), scratch_path(spark, "state")

    def run(stream: DataFrame) -> StreamingQuery:
        staged = staging.stage_market_data(adapters.bronze(stream), as_of, None)
        return rollups.run_hourly(staged, out, state, DELAY, available_now=True)

    replay(events, run)
    hourly = rollups.read_hourly(spark, out, as_of)
    return hourly.withColumns(
        {
            name: F.col(name).cast("timestamp_ntz")
            for name in ("hour_timestamp", "aggregated_at")
        }
    )


def hourly_stream(spark, sf_dir):
    return _hourly(spark, sf_dir)


def latest_stream(spark, sf_dir):
    return gold.latest_sentiment(_hourly(spark, sf_dir), "previous_hour")


def trend_changes_stream(spark, sf_dir):
    return gold.trend_changes(_hourly(spark, sf_dir))


def _with_heartbeat(staged: DataFrame, stream: DataFrame) -> DataFrame:
    """Staged messages, and the heartbeats of the stream as rows without a score."""
    beats = stream.filter(F.col("event_type") == HEARTBEAT).select(F.col("ts").alias("ingested_at"))
    return staged.unionByName(beats, allowMissingColumns=True)


def live_trend_changes(spark, sf_dir):
    """Changes of trend told while the stream runs; a heartbeat closes the last hours."""
    events = table(spark, sf_dir, "events")
    as_of = adapters.as_of(spark, sf_dir)
    out, state = scratch_path(spark, "trends"), scratch_path(spark, "state")
    beat = events.agg((F.max("ts") + F.expr("INTERVAL 3 HOURS")).alias("ts")).withColumn(
        "event_type", F.lit(HEARTBEAT)
    )

    def run(stream: DataFrame) -> StreamingQuery:
        messages = stream.filter(F.col("event_type") != HEARTBEAT)
        staged = staging.stage_market_data(adapters.bronze(messages), as_of, None)
        beating = _with_heartbeat(staged, stream)
        return trends.run_trend_changes(beating, out, state, SHORT_DELAY, available_now=True)

    replay(events.unionByName(beat, allowMissingColumns=True), run)
    found = spark.read.parquet(f"{out}/changes").drop(sinks.RUN, sinks.BATCH)
    return found.withColumn("hour_timestamp", F.col("hour_timestamp").cast("timestamp_ntz"))


def _failing_handler():
    """A handler that fails on the first k % 4 attempts, every other time by raising."""

    def accepts(ident: str, message: str, attempt: int) -> bool:
        k = int(message)
        if attempt <= k % 4 and k % 8 < 4:
            raise RuntimeError(f"attempt {attempt} broke")
        return attempt > k % 4

    return accepts


def redelivery_stream(spark, sf_dir):
    """Every event as a message that fails up to three times; a heartbeat brings the
    last ones back."""
    events = table(spark, sf_dir, "events")
    out, state = scratch_path(spark, "redelivery"), scratch_path(spark, "state")
    beat = events.agg((F.max("ts") + F.expr("INTERVAL 3 HOURS")).alias("ts")).withColumn(
        "event_id", F.lit(-1).cast("long")
    ).withColumn("props", F.lit('{"k": 0}'))

    def run(stream: DataFrame) -> StreamingQuery:
        messages = stream.select(
            F.col("event_id").cast("string").alias("id"),
            adapters.k_of().cast("string").alias("message"),
            F.col("ts").alias("at"),
        )
        return redelivery.run_redelivery(
            messages, out, state, _failing_handler, "raw", SHORT_DELAY, available_now=True
        )

    replay(events.unionByName(beat, allowMissingColumns=True), run)
    tried = spark.read.parquet(f"{out}/attempts").drop(sinks.RUN, sinks.BATCH)
    tried = tried.filter(F.col("id") != "-1")
    return tried.withColumns(
        {name: F.col(name).cast("timestamp_ntz") for name in ("at", "next_try")}
    )


def newest_message_stream(spark, sf_dir):
    out, state = scratch_path(spark, "newest"), scratch_path(spark, "state")

    def run(stream: DataFrame) -> StreamingQuery:
        rows = adapters.staged_columns(stream).filter(F.col("symbol").isNotNull())
        newest = rollups.newest_messages(rows)
        return sinks.keep_versions(newest, out, state, available_now=True)

    replay(table(spark, sf_dir, "events"), run)
    return sinks.current_version(spark, out, ["symbol"]).withColumn(
        "ingested_at", F.col("ingested_at").cast("timestamp_ntz")
    )


def dedupe_stream(spark, sf_dir):
    """Every error event is delivered twice; one delivery is kept."""
    events = table(spark, sf_dir, "events")
    delivered = events.unionByName(events.filter(F.col("event_type") == "error"))
    kept = _appended(
        delivered,
        lambda stream: rollups.drop_replays(stream, "event_id", "ts", DELAY),
        "deduped",
    )
    return kept.select("event_id", "event_type", "value")


def sentiment_updates_stream(spark, sf_dir):
    def build(stream: DataFrame) -> DataFrame:
        rows = adapters.staged_columns(stream).withColumn(
            "sentiment_category", sentiment.row_category(F.col("sentiment_score"))
        )
        return routing.sentiment_updates(rows, iso_text(F.col("ingested_at")))

    sent = _appended(table(spark, sf_dir, "events"), build, "updates")
    return sent.select(
        "id",
        "symbol",
        F.get_json_object("event", "$.timestamp").alias("timestamp"),
        F.get_json_object("event", "$.data.sentiment_category").alias("category"),
    )


def price_alerts_stream(spark, sf_dir):
    def build(stream: DataFrame) -> DataFrame:
        rows = adapters.staged_columns(stream)
        moment = iso_text(F.col("ingested_at"))
        return routing.price_alerts(rows, live.ALERT_THRESHOLD, moment)

    sent = _appended(table(spark, sf_dir, "events"), build, "alerts")
    return sent.select("id", F.get_json_object("event", "$.data.direction").alias("direction"))


def route_stream(spark, sf_dir):
    """Events of a stream joined to the subscriptions as they stand."""
    events = table(spark, sf_dir, "events")
    actions = adapters.client_actions(events)
    subscriptions = routing.current_subscriptions(actions)
    clients = routing.connected_clients(actions)

    def build(stream: DataFrame) -> DataFrame:
        rows = adapters.staged_columns(stream)
        sent = rows.select("id", F.col("event_type").alias("symbol"))
        return routing.route_events(sent, subscriptions, clients)

    return _appended(events, build, "routed")


def rate_limit_stream(spark, sf_dir):
    """The hourly limit of every event type, flagged batch by batch."""
    out, state = scratch_path(spark, "limited"), scratch_path(spark, "state")

    def run(stream: DataFrame) -> StreamingQuery:
        requests = stream.select("event_id", "event_type", "ts")
        return run_rate_limit(
            requests, out, state, "event_type", "ts", 2, 3600, ("event_id",), True
        )

    replay(table(spark, sf_dir, "events"), run)
    flags = spark.read.parquet(f"{out}/flags").drop(sinks.RUN, sinks.BATCH)
    return flags.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def ingest_stream(spark, sf_dir):
    """Bronze rows written by the continuous ingest."""
    events = table(spark, sf_dir, "events")
    as_of = adapters.as_of(spark, sf_dir)
    out, state = scratch_path(spark, "ingest"), scratch_path(spark, "state")

    def run(stream: DataFrame) -> StreamingQuery:
        pushed = adapters.envelopes(stream)
        return run_ingest(pushed, out, state, messages.TOPIC, as_of, available_now=True)

    replay(events, run, costly=True)
    return messages.bronze_view(spark.read.parquet(f"{out}/bronze"))


QUERIES = {
    f.__name__: f
    for f in (
        hourly_stream,
        latest_stream,
        trend_changes_stream,
        live_trend_changes,
        redelivery_stream,
        newest_message_stream,
        dedupe_stream,
        sentiment_updates_stream,
        price_alerts_stream,
        route_stream,
        rate_limit_stream,
        ingest_stream,
    )
}

_STAMP = "strftime(ingested_at, '%Y-%m-%dT%H:%M:%S.%f')"

ORACLE = {
    "hourly_stream": market.ORACLE["gold_hourly_sentiment"],
    "latest_stream": market.ORACLE["gold_latest_prev_hour"],
    "trend_changes_stream": market.ORACLE["trend_changes"],
    "live_trend_changes": market.ORACLE["trend_changes"],
    "redelivery_stream": """
WITH messages AS (
    SELECT CAST(event_id AS VARCHAR) AS id, ts, CAST(props->>'$.k' AS INTEGER) AS k FROM events
), tries AS (
    SELECT *, unnest([1, 2, 3]) AS attempt FROM messages
)
SELECT id, attempt, ts + to_seconds([0, 10, 30][attempt]) AS at,
       CASE WHEN attempt > k % 4 THEN 'done' WHEN attempt = 3 THEN 'dead' ELSE 'retry' END AS outcome,
       CASE WHEN attempt <= k % 4 AND attempt < 3 THEN ts + to_seconds([10, 30][attempt]) END AS next_try,
       CASE WHEN attempt > k % 4 THEN NULL WHEN k % 8 < 4 THEN 'attempt ' || attempt || ' broke'
            ELSE 'Handler returned failure' END AS error
FROM tries WHERE attempt <= k % 4 + 1""",
    "newest_message_stream": f"""WITH {sql.STAGED}
SELECT upper(symbol) AS symbol, id, sentiment_score, price_usd, ingested_at FROM staged
QUALIFY row_number() OVER (PARTITION BY upper(symbol) ORDER BY ingested_at DESC, id DESC) = 1""",
    "dedupe_stream": "SELECT event_id, event_type, value FROM events",
    "sentiment_updates_stream": f"""WITH {sql.MESSAGES}
SELECT id, coalesce(symbol, 'UNKNOWN') AS symbol, {_STAMP} AS timestamp,
       CASE WHEN sentiment_score >= 7 THEN 'BULLISH' WHEN sentiment_score < 4 THEN 'BEARISH'
            ELSE 'NEUTRAL' END AS category
FROM messages WHERE sentiment_score IS NOT NULL AND sentiment_score <> 0""",
    "price_alerts_stream": f"""WITH {sql.MESSAGES}
SELECT id, CASE WHEN percent_change_24h > 0 THEN 'up' ELSE 'down' END AS direction
FROM messages WHERE abs(percent_change_24h) >= {live.ALERT_THRESHOLD}""",
    "route_stream": live.ORACLE["route_events"],
    "rate_limit_stream": live.ORACLE["rate_limit"],
    "ingest_stream": messages.ORACLE["ingest_bronze"],
}
