"""Live events, subscriptions, rate limits and metric rollups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import sentiment
from tidemark.functions.times import iso_text
from tidemark.operators import audience, gold, metrics, quantiles, ratelimit, routing, staging
from tidemark.plans.storage import settle
from workload import adapters, sql
from workload.adapters import table
from workload.market import _TRENDS

ALERT_THRESHOLD = 4.0
SHARES = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]
BOUNDS = [1.0, 10.0, 25.0, 50.0, 100.0, 250.0]


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events")


def _messages(spark, sf_dir):
    return adapters.staged_columns(_events(spark, sf_dir))


def _addressed(spark, sf_dir):
    """All messages as events of their symbol."""
    return _messages(spark, sf_dir).select("id", F.col("event_type").alias("symbol"))


def _actions(spark, sf_dir):
    return adapters.client_actions(_events(spark, sf_dir))


def _audience(spark, sf_dir):
    actions = _actions(spark, sf_dir)
    return routing.current_subscriptions(actions), routing.connected_clients(actions)


def _opened(df):
    """Event JSON by its fields, which compare where number formats may not."""

    def read(path: str):
        return F.get_json_object("event", path)

    return df.withColumns(
        {
            "type": read("$.type"),
            "event_symbol": read("$.symbol"),
            "timestamp": read("$.timestamp"),
        }
    )


def sentiment_updates(spark, sf_dir):
    messages = _messages(spark, sf_dir).withColumn(
        "sentiment_category", sentiment.row_category(F.col("sentiment_score"))
    )
    updates = routing.sentiment_updates(messages, iso_text(F.col("ingested_at")))
    return _opened(updates).select(
        "id",
        "symbol",
        "type",
        "event_symbol",
        "timestamp",
        F.get_json_object("event", "$.data.sentiment_score")
        .cast("double")
        .alias("score"),
        F.get_json_object("event", "$.data.sentiment_category").alias("category"),
        F.get_json_object("event", "$.data.reasoning").alias("reasoning"),
    )


def price_alerts(spark, sf_dir):
    alerts = routing.price_alerts(
        _messages(spark, sf_dir), ALERT_THRESHOLD, iso_text(F.col("ingested_at"))
    )
    return _opened(alerts).select(
        "id",
        "type",
        "event_symbol",
        "timestamp",
        F.get_json_object("event", "$.data.price_usd").cast("double").alias("price"),
        F.get_json_object("event", "$.data.change_percent")
        .cast("double")
        .alias("change"),
        F.get_json_object("event", "$.data.direction").alias("direction"),
    )


def trend_events(spark, sf_dir):
    events = _events(spark, sf_dir)
    as_of = adapters.as_of(spark, sf_dir)
    staged = staging.stage_market_data(adapters.bronze(events), as_of, None)
    changes = gold.trend_changes(gold.hourly_sentiment(staged, as_of))
    sent = routing.trend_events(changes, iso_text(F.col("hour_timestamp")))
    return _opened(sent).select(
        "symbol",
        "hour_timestamp",
        "type",
        "timestamp",
        F.get_json_object("event", "$.data.previous_trend").alias("previous_trend"),
        F.get_json_object("event", "$.data.sentiment_trend").alias("sentiment_trend"),
    )


def subscribe(spark, sf_dir):
    return routing.subscribe(_messages(spark, sf_dir), ["Click", "VIEW"]).select(
        "id", "symbol"
    )


def current_subscriptions(spark, sf_dir):
    return _audience(spark, sf_dir)[0]


def connected_clients(spark, sf_dir):
    return _audience(spark, sf_dir)[1]


def subscription_stats(spark, sf_dir):
    return routing.subscription_stats(*_audience(spark, sf_dir))


def route_events(spark, sf_dir):
    return routing.route_events(_addressed(spark, sf_dir), *_audience(spark, sf_dir))


def route_events_once(spark, sf_dir):
    return routing.route_events(
        _addressed(spark, sf_dir), *_audience(spark, sf_dir), dedupe=True
    )


def route_events_subscribed(spark, sf_dir):
    return routing.route_events(
        _addressed(spark, sf_dir), *_audience(spark, sf_dir), mode="subscribed"
    )


def _timed(spark, sf_dir):
    """All messages as events of their symbol, at their time."""
    rows = _messages(spark, sf_dir)
    return rows.select("id", F.col("event_type").alias("symbol"), F.col("ingested_at").alias("ts"))


def route_as_of(spark, sf_dir):
    """Every message to those who listened at its time."""
    return audience.route_as_of(_timed(spark, sf_dir), _actions(spark, sf_dir))


def route_as_of_once(spark, sf_dir):
    return audience.route_as_of(_timed(spark, sf_dir), _actions(spark, sf_dir), dedupe=True)


def subscription_spans(spark, sf_dir):
    return audience.subscription_spans(_actions(spark, sf_dir))


def delivery_counts(spark, sf_dir):
    return routing.delivery_counts(_addressed(spark, sf_dir), *_audience(spark, sf_dir))


def client_feed(spark, sf_dir):
    subscriptions, _ = _audience(spark, sf_dir)
    return routing.client_feed(_addressed(spark, sf_dir), subscriptions, "c3")


def rate_limit(spark, sf_dir):
    """At most two requests an hour for every event type."""
    requests = _events(spark, sf_dir).select("event_id", "event_type", "ts")
    return ratelimit.rate_limit(
        requests, "event_type", "ts", 2, 3600, order=("event_id",)
    )


def rate_limit_users(spark, sf_dir):
    """At most one request in ten minutes for every user."""
    requests = _events(spark, sf_dir).select("event_id", "user_id", "ts")
    return ratelimit.rate_limit(requests, "user_id", "ts", 1, 600, order=("event_id",))


def counter_rollup(spark, sf_dir):
    return metrics.counter_rollup(adapters.metric_events(_events(spark, sf_dir)))


def histogram_rollup(spark, sf_dir):
    rolled = metrics.histogram_rollup(
        adapters.metric_events(_events(spark, sf_dir)), BOUNDS
    )
    counts = F.transform("buckets", lambda n: n.cast("string"))
    return rolled.withColumn("buckets", F.array_join(counts, ","))


def daily_quantiles(spark, sf_dir):
    """Quantiles by day from stored hourly sketches, held against exact ranks: twice the
    stated rank error is kept to but for one case in thousands."""
    events = adapters.metric_events(_events(spark, sf_dir))
    stored = settle(quantiles.hourly_sketches(events), "sketches")
    found = settle(quantiles.quantiles(quantiles.merged(stored), SHARES), "quantiles")
    checked = quantiles.observed_error(events, found)
    return checked.select(
        "day",
        "name",
        "attributes",
        "share",
        "n",
        (F.col("error") <= 2 * quantiles.rank_error(quantiles.K)).alias("within"),
    )


def ignored_metrics(spark, sf_dir):
    return metrics.ignored_metrics(adapters.metric_events(_events(spark, sf_dir)))


def running_level(spark, sf_dir):
    return metrics.running_level(
        adapters.connection_events(_events(spark, sf_dir)), ["ts", "event_id"]
    )


def error_rollup(spark, sf_dir):
    rows = _messages(spark, sf_dir)
    return metrics.error_rollup(
        rows.filter(F.col("event_type") == "error").select(
            F.concat(F.lit("E"), F.col("k") % 7).alias("error_type"),
            F.col("source").alias("service"),
            F.when(F.col("k") < 50, "insert").otherwise("query").alias("operation"),
        )
    )


def latency_ms(spark, sf_dir):
    """Calls that start with the event and last its value in milliseconds."""
    micros = F.round(F.col("value") * 1000).cast("bigint")
    spans = _events(spark, sf_dir).select(
        "event_id",
        F.col("ts").alias("start_ts"),
        F.timestamp_micros(
            F.unix_micros(F.col("ts").cast("timestamp")) + micros
        ).alias("end_ts"),
    )
    return metrics.latency_ms(spans).select("event_id", "latency_ms")


QUERIES = {
    f.__name__: f
    for f in (
        sentiment_updates,
        price_alerts,
        trend_events,
        subscribe,
        current_subscriptions,
        connected_clients,
        subscription_stats,
        route_events,
        route_events_once,
        route_events_subscribed,
        route_as_of,
        route_as_of_once,
        subscription_spans,
        delivery_counts,
        client_feed,
        rate_limit,
        rate_limit_users,
        counter_rollup,
        histogram_rollup,
        daily_quantiles,
        ignored_metrics,
        running_level,
        error_rollup,
        latency_ms,
    )
}

_STAMP = "strftime(ingested_at, '%Y-%m-%dT%H:%M:%S.%f')"

_AUDIENCE = sql.MESSAGES + """,
actions AS (
  SELECT 'c' || user_id AS client, ingested_at AS ts, event_id AS seq,
         CASE WHEN event_type = 'purchase' THEN 'connect'
              WHEN event_type = 'signup' THEN 'unsubscribe'
              WHEN event_type = 'error' AND k < 50 THEN 'disconnect'
              ELSE 'subscribe' END AS action,
         ['click', 'error', 'purchase', 'signup', 'view'] AS types, k
  FROM messages
),
wishes AS (
  SELECT client, ts, seq, action, upper(types[1 + k % 5]) AS symbol FROM actions
  UNION ALL
  SELECT client, ts, seq, action, upper(types[1 + (k // 5) % 5]) FROM actions
),
gone AS (
  SELECT client, max(ts) AS ts FROM actions WHERE action = 'disconnect' GROUP BY client
),
subs AS (
  SELECT client, symbol FROM (
    SELECT * FROM wishes WHERE action <> 'disconnect'
    QUALIFY row_number() OVER (PARTITION BY client, symbol ORDER BY ts DESC, seq DESC) = 1) w
  WHERE action <> 'unsubscribe'
    AND NOT EXISTS (SELECT 1 FROM gone WHERE gone.client = w.client AND gone.ts > w.ts)
),
clients AS (
  SELECT client FROM (
    SELECT client, max(ts) AS ts FROM actions WHERE action <> 'disconnect' GROUP BY client) c
  WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.client = c.client AND gone.ts > c.ts)
),
listeners AS (SELECT symbol, count(*) AS n FROM subs GROUP BY symbol)"""

_TO_SYMBOL = """
SELECT id, upper(event_type) AS symbol, upper(event_type) AS channel, n AS recipients
FROM messages JOIN listeners ON listeners.symbol = upper(event_type)"""


_SPANS = _AUDIENCE + """,
states AS (
  SELECT DISTINCT client, symbol, ts, seq, action = 'unsubscribe' AS off FROM wishes
  WHERE action <> 'disconnect'
  UNION ALL
  SELECT a.client, p.symbol, a.ts, a.seq, true FROM actions a
  JOIN (SELECT DISTINCT client, symbol FROM wishes WHERE action <> 'disconnect') p
    ON p.client = a.client WHERE a.action = 'disconnect'
),
flips AS (
  SELECT * FROM states
  QUALIFY off <> coalesce(lag(off) OVER (PARTITION BY client, symbol ORDER BY ts, seq, off), true)
),
spans AS (
  SELECT * FROM (SELECT *, lead(ts) OVER (PARTITION BY client, symbol ORDER BY ts, seq, off) AS until FROM flips)
  WHERE NOT off AND (until IS NULL OR until > ts)
),
levels AS (
  SELECT symbol, ts, sum(sum(CASE WHEN off THEN -1 ELSE 1 END)) OVER (PARTITION BY symbol ORDER BY ts) AS n
  FROM flips GROUP BY symbol, ts
),
presence AS (
  SELECT client, ts, action = 'disconnect' AS off FROM actions
  QUALIFY off <> coalesce(lag(off) OVER (PARTITION BY client ORDER BY ts, seq, off), true)
),
crowd AS (
  SELECT ts, sum(sum(CASE WHEN off THEN -1 ELSE 1 END)) OVER (ORDER BY ts) AS n FROM presence GROUP BY ts
),
reached AS (
  SELECT m.id, upper(m.event_type) AS symbol, coalesce(l.n, 0) AS own, coalesce(c.n, 0) AS everybody
  FROM messages m
  ASOF LEFT JOIN levels l ON l.symbol = upper(m.event_type) AND l.ts <= m.ingested_at
  ASOF LEFT JOIN crowd c ON c.ts <= m.ingested_at
)"""


def _as_of_channels(rest: str) -> str:
    return f"""WITH {_SPANS}
SELECT id, symbol, symbol AS channel, CAST(own AS BIGINT) AS recipients FROM reached WHERE own > 0
UNION ALL
SELECT id, symbol, 'all', CAST({rest} AS BIGINT) FROM reached WHERE {rest} > 0"""


def _limited(key: str, limit: int, seconds: int) -> str:
    return f"""WITH RECURSIVE requests AS (SELECT event_id, {key}, ts FROM events),
anchors AS (
  SELECT {key}, min(ts) AS start FROM requests GROUP BY {key}
  UNION ALL
  SELECT r.{key}, min(r.ts) FROM anchors a JOIN requests r
    ON r.{key} = a.{key} AND r.ts >= a.start + INTERVAL {seconds} SECOND
  GROUP BY r.{key}
),
placed AS (
  SELECT r.*, a.start FROM requests r ASOF JOIN anchors a
    ON r.{key} = a.{key} AND r.ts >= a.start
),
numbered AS (
  SELECT event_id, {key}, ts,
         row_number() OVER (PARTITION BY {key}, start ORDER BY ts, event_id) AS request_number
  FROM placed
)
SELECT *, request_number <= {limit} AS allowed,
       greatest(0, {limit} - request_number) AS remaining
FROM numbered"""


_METRICS = sql.MESSAGES + """,
metrics AS (
  SELECT CASE event_type WHEN 'click' THEN 'request_count' WHEN 'view' THEN 'request_latency'
                         WHEN 'purchase' THEN 'bigquery_rows' WHEN 'error' THEN 'processing_latency'
                         ELSE 'unheard_of' END AS name,
         CASE WHEN k % 3 = 0 THEN '{}' ELSE '{"app":"web","zone":"' || (k % 2) || '"}' END AS attributes,
         value, ingested_at
  FROM messages
)"""

_BUCKETS = " || ',' || ".join(
    f"count(*) FILTER (WHERE {condition})"
    for condition in [
        f"value <= {BOUNDS[0]}",
        *[f"value > {low} AND value <= {high}" for low, high in zip(BOUNDS, BOUNDS[1:])],
        f"value > {BOUNDS[-1]}",
    ]
)

ORACLE = {
    "sentiment_updates": f"""WITH {sql.MESSAGES}
SELECT id, coalesce(symbol, 'UNKNOWN') AS symbol, 'sentiment_update' AS type,
       coalesce(symbol, 'UNKNOWN') AS event_symbol, {_STAMP} AS timestamp, sentiment_score AS score,
       CASE WHEN sentiment_score >= 7 THEN 'BULLISH' WHEN sentiment_score < 4 THEN 'BEARISH'
            ELSE 'NEUTRAL' END AS category, sentiment_reasoning AS reasoning
FROM messages WHERE sentiment_score IS NOT NULL AND sentiment_score <> 0""",
    "price_alerts": f"""WITH {sql.MESSAGES}
SELECT id, 'price_alert' AS type, symbol AS event_symbol, {_STAMP} AS timestamp, price_usd AS price,
       percent_change_24h AS change, CASE WHEN percent_change_24h > 0 THEN 'up' ELSE 'down' END AS direction
FROM messages WHERE abs(percent_change_24h) >= {ALERT_THRESHOLD}""",
    "trend_events": f"""WITH {sql.hourly()}{_TRENDS}
SELECT symbol, hour_timestamp, 'trend_change' AS type,
       strftime(hour_timestamp, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, previous_trend, sentiment_trend
FROM (SELECT *, lag(sentiment_trend) OVER (PARTITION BY symbol ORDER BY hour_timestamp) AS previous_trend
      FROM trends)
WHERE sentiment_trend <> previous_trend""",
    "subscribe": f"""WITH {sql.MESSAGES}
SELECT id, symbol FROM messages WHERE upper(symbol) IN ('CLICK', 'VIEW')""",
    "current_subscriptions": f"WITH {_AUDIENCE} SELECT client, symbol FROM subs",
    "connected_clients": f"WITH {_AUDIENCE} SELECT client FROM clients",
    "subscription_stats": f"""WITH {_AUDIENCE}
SELECT 'all' AS channel, count(*) AS clients FROM clients
UNION ALL SELECT symbol, n FROM listeners""",
    "route_events": f"""WITH {_AUDIENCE} {_TO_SYMBOL}
UNION ALL SELECT id, upper(event_type), 'all', (SELECT count(*) FROM clients)
FROM messages WHERE (SELECT count(*) FROM clients) > 0""",
    "route_events_once": f"""WITH {_AUDIENCE} {_TO_SYMBOL}
UNION ALL SELECT id, upper(event_type), 'all', rest
FROM (SELECT id, event_type, (SELECT count(*) FROM clients) - coalesce(n, 0) AS rest
      FROM messages LEFT JOIN listeners ON listeners.symbol = upper(event_type))
WHERE rest > 0""",
    "route_events_subscribed": f"WITH {_AUDIENCE} {_TO_SYMBOL}",
    "route_as_of": _as_of_channels("everybody"),
    "route_as_of_once": _as_of_channels("(everybody - own)"),
    "subscription_spans": f"""WITH {_SPANS}
SELECT client, symbol, ts AS from_ts, until AS to_ts FROM spans""",
    "delivery_counts": f"""WITH {_AUDIENCE}
SELECT client,
       (SELECT count(*) FROM messages JOIN subs ON subs.symbol = upper(event_type)
        WHERE subs.client = clients.client) AS by_symbol,
       (SELECT count(*) FROM messages) AS broadcast
FROM clients""",
    "client_feed": f"""WITH {_AUDIENCE}
SELECT upper(event_type) AS symbol, id FROM messages
WHERE upper(event_type) IN (SELECT symbol FROM subs WHERE client = 'c3')""",
    "rate_limit": _limited("event_type", 2, 3600),
    "rate_limit_users": _limited("user_id", 1, 600),
    "counter_rollup": f"""WITH {_METRICS}
SELECT name, attributes, CAST(sum(CAST(value AS DECIMAL(38,9))) AS DOUBLE) AS total, count(*) AS events
FROM metrics WHERE name IN ('request_count', 'bigquery_rows') GROUP BY name, attributes""",
    "histogram_rollup": f"""WITH {_METRICS}
SELECT name, attributes, count(*) AS count, CAST(sum(CAST(value AS DECIMAL(38,9))) AS DOUBLE) AS sum,
       min(value) AS min, max(value) AS max, {_BUCKETS} AS buckets
FROM metrics WHERE name IN ('request_latency', 'processing_latency') GROUP BY name, attributes""",
    "daily_quantiles": f"""WITH {_METRICS},
days AS (
  SELECT date_trunc('day', ingested_at) AS day, name, attributes, count(*) AS n
  FROM metrics WHERE name IN ('request_latency', 'processing_latency') GROUP BY ALL
)
SELECT day, name, attributes, unnest({SHARES}::DOUBLE[]) AS share, n, true AS within FROM days""",
    "ignored_metrics": f"""WITH {_METRICS}
SELECT name, count(*) AS ignored FROM metrics WHERE name = 'unheard_of' GROUP BY name""",
    "running_level": f"""WITH changes AS (
  SELECT event_id, ts, 'active_connections' AS name,
         CAST(CASE event_type WHEN 'signup' THEN 1 WHEN 'error' THEN -1 ELSE 0 END AS BIGINT) AS value
  FROM events)
SELECT *, CAST(sum(value) OVER (ORDER BY ts, event_id) AS BIGINT) AS level FROM changes""",
    "error_rollup": f"""WITH {sql.MESSAGES}
SELECT 'E' || (k % 7) AS error_type, source AS service,
       CASE WHEN k < 50 THEN 'insert' ELSE 'query' END AS operation, count(*) AS errors
FROM messages WHERE event_type = 'error' GROUP BY 1, 2, 3""",
    "latency_ms": """
SELECT event_id, round(value * 1000) / 1000 AS latency_ms FROM events""",
}
