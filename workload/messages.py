"""Ingest, text and message queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import numbers, sentiment, text
from tidemark.operators import deadletter, enrich, ingest
from tidemark.plans.skew import spread
from tidemark.sources import envelope
from workload import adapters, sql
from workload.adapters import table

TOPIC = "market-data"
PROMPT_FIELDS = [
    "symbol",
    "price_usd",
    "volume_24h",
    "market_cap",
    "percent_change_24h",
    "news_headline",
]


def _events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    events = table(spark, sf_dir, "events")
    return events, adapters.as_of(spark, sf_dir)


def _ingested(spark: SparkSession, sf_dir: str) -> ingest.Ingested:
    events, as_of = _events(spark, sf_dir)
    return ingest.ingest(adapters.envelopes(spread(events)), as_of, TOPIC)


def decode_envelope(spark, sf_dir):
    events, _ = _events(spark, sf_dir)
    return envelope.decode_envelope(adapters.envelopes(events)).select(
        "message_id",
        F.get_json_object("payload", "$.symbol").alias("symbol"),
        "source",
        "publish_time",
        "error",
    )


def bronze_view(rows: DataFrame) -> DataFrame:
    """Bronze rows with the metadata JSON opened, to compare its fields."""
    meta = "processing_metadata"
    return rows.select(
        "id",
        F.get_json_object("raw_payload", "$.symbol").alias("symbol"),
        "source",
        F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"),
        numbers.snap_round(F.col("sentiment_score"), 6).alias("sentiment_score"),
        "sentiment_reasoning",
        F.get_json_object(meta, "$.function_version").alias("function_version"),
        F.get_json_object(meta, "$.pinecone_indexed").alias("indexed"),
        F.get_json_object(meta, "$.pubsub_publish_time").alias("publish_time"),
    )


def ingest_bronze(spark, sf_dir):
    return bronze_view(_ingested(spark, sf_dir).bronze)


def ingest_vectors(spark, sf_dir):
    return _ingested(spark, sf_dir).vectors.select(
        "namespace",
        "id",
        "metadata.symbol",
        "metadata.source",
        "metadata.sentiment_category",
        "metadata.price_usd",
        "metadata.news_headline",
    )


def dead_letters(spark, sf_dir):
    return _ingested(spark, sf_dir).dead_letters


def decode_json(spark, sf_dir):
    """Topic records by outcome; unreadable bytes are kept as base64."""
    events, as_of = _events(spark, sf_dir)
    decoded = envelope.decode_json(adapters.topic_records(events))
    rejects = decoded.filter(F.col("payload").isNull()).withColumn(
        "error", F.lit(envelope.UNDECODABLE)
    )
    return deadletter.to_dead_letter(rejects, "value", F.col("topic"), as_of)


def typed_message(spark, sf_dir):
    events, as_of = _events(spark, sf_dir)
    decoded = envelope.decode_json(adapters.topic_records(events))
    return envelope.typed_message(decoded.filter(F.col("payload").isNotNull()), as_of)


def handled_messages(spark, sf_dir):
    """Refusals of a handler that accepts messages with a price."""
    events, as_of = _events(spark, sf_dir)
    accepted, refused = deadletter.handle(
        adapters.staged_columns(events).select("id", "symbol", "price_usd"),
        lambda df: df["symbol"].isNotNull() & (df["price_usd"] > 50),
    )
    return accepted.withColumn("error", F.lit(None).cast("string")).unionByName(refused)


def publish_rows(spark, sf_dir):
    events, _ = _events(spark, sf_dir)
    rows = adapters.staged_columns(events)
    return envelope.message_records(
        rows.select("id", "symbol", "news_headline", "source", "user_id"), "symbol"
    )


def route_failures(spark, sf_dir):
    """Failed deliveries, the first to the fourth attempt by k, sent back or dead."""
    events, as_of = _events(spark, sf_dir)
    rows = adapters.staged_columns(events)
    failed = rows.select("id", (1 + F.col("k") % 4).alias("attempt"))
    retry, dead = deadletter.route_failures(failed, as_of)
    return retry.withColumn("route", F.lit("retry")).unionByName(
        dead.withColumns(
            {"route": F.lit("dead"), "next_try": F.lit(None).cast("timestamp_ntz")}
        )
    )


def expire(spark, sf_dir):
    """Events within the retention time of the bronze topic."""
    events, as_of = _events(spark, sf_dir)
    return deadletter.expire(
        events, "ts", as_of, envelope.RETENTION_HOURS["bronze"]
    ).select("event_id", "ts")


def parse_score_reply(spark, sf_dir):
    events, _ = _events(spark, sf_dir)
    parsed = sentiment.parse_score_reply(F.col("reply"))
    return adapters.replies(events).select("event_id", parsed.alias("p")).select(
        "event_id", "p.score", "p.reasoning"
    )


def clamp_score(spark, sf_dir):
    events, _ = _events(spark, sf_dir)
    raw = F.when(adapters.k_of() % 10 != 0, F.col("value") / 50)
    return events.select(
        "event_id",
        numbers.clamp_score(raw).alias("score"),
        sentiment.row_category(raw).alias("category"),
    )


def searchable_text(spark, sf_dir):
    events, _ = _events(spark, sf_dir)
    return adapters.staged_columns(events).select(
        "id",
        text.searchable_text(
            F.col("symbol"),
            F.col("volume_24h"),
            F.col("percent_change_24h"),
            F.col("news_headline"),
            F.lit(None).cast("string"),
            F.col("sentiment_reasoning"),
        ).alias("text"),
    )


def searchable_text_news(spark, sf_dir):
    """Documents as news: the whole text goes in, the feature keeps its first part."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        text.searchable_text(
            F.upper("lang"),
            F.col("n_chars").cast("double"),
            F.lit(0.0),
            F.col("source"),
            F.col("text"),
            F.lit(""),
        ).alias("text"),
    )


def payload_text(spark, sf_dir):
    """Searchable text of the raw payloads; none where the price is not a number."""
    events, _ = _events(spark, sf_dir)
    rows = adapters.bronze(events)
    return enrich.with_search_text(rows, "raw_payload", "sentiment_reasoning").select(
        "id", F.col("search_text").alias("text")
    )


def prompt_text(spark, sf_dir):
    events, _ = _events(spark, sf_dir)
    rows = adapters.staged_columns(events)
    return rows.select("id", text.prompt_text(rows, PROMPT_FIELDS).alias("prompt"))


def stable_key(spark, sf_dir):
    events, _ = _events(spark, sf_dir)
    rows = adapters.staged_columns(events)
    key = text.stable_key(
        "lake", "sentiment", [F.col("k")], {"symbol": F.col("symbol"), "hours": F.lit(24)}
    )
    return rows.select("id", key.alias("key"))


def short_hash(spark, sf_dir):
    events, _ = _events(spark, sf_dir)
    rows = adapters.staged_columns(events)
    return rows.select(
        "id", text.short_hash(rows, ["symbol", "k", "user_id"]).alias("hash")
    )


QUERIES = {
    f.__name__: f
    for f in (
        decode_envelope,
        ingest_bronze,
        ingest_vectors,
        dead_letters,
        decode_json,
        typed_message,
        handled_messages,
        publish_rows,
        route_failures,
        expire,
        parse_score_reply,
        clamp_score,
        searchable_text,
        searchable_text_news,
        payload_text,
        prompt_text,
        stable_key,
        short_hash,
    )
}

_EMPTY = "'Empty message data'"
_BAD = "'Deserialization failed'"

# Envelopes by k: 1 empty, 2 no base64, 3 unfinished JSON, 4 a list, 5 without id.
_PUSHED = sql.MESSAGES + f""",
pushed AS (
  SELECT *,
         '{{"symbol": "' || event_type || '"' AS opening,
         CASE WHEN k = 1 THEN {_EMPTY} WHEN k IN (2, 3, 4) THEN {_BAD} END AS error,
         strftime(ingested_at, '%Y-%m-%dT%H:%M:%S') AS publish_time
  FROM messages
),
named AS (
  SELECT *,
         CASE WHEN k = 5 THEN sha256(to_base64(encode(opening || ', "source": "feed"}}')))
              ELSE id END AS message_id,
         CASE WHEN error IS NOT NULL THEN NULL WHEN k % 3 = 0 THEN source
              WHEN k = 5 THEN 'feed' ELSE 'unknown' END AS resolved_source,
         CASE WHEN error IS NULL THEN symbol END AS read_symbol,
         error IS NULL AND k % 7 <> 0 AND k % 4 <> 2 AND k <> 13 AS with_vector
  FROM pushed
)"""

_SCORE = "greatest(CAST(1 AS DOUBLE), least(CAST(10 AS DOUBLE), 5 + percent_change_24h))"
_STAMP = "strftime(as_of, '%Y-%m-%dT%H:%M:%S.%f')"


def _text(price: str, change: str, reasoning: str, empty_when: str = "false") -> str:
    return f"""concat_ws(' | ',
         'Cryptocurrency: ' || symbol,
         CASE WHEN {price} <> 0 THEN 'Price: $' || format('{{:,.2f}}', {price}) END,
         CASE WHEN {change} <> 0 THEN '24h change: ' || CASE WHEN {change} > 0 THEN 'up' ELSE 'down' END
              || ' ' || format('{{:.2f}}', abs({change})) || '%' END,
         'News: ' || news_headline,
         'Analysis: ' || {reasoning})"""


_PROMPT_HEAD, _PROMPT_TAIL = text.SCORE_PROMPT.split("{market_data}")


def _json_number(column: str) -> str:
    return f"CAST({column} AS VARCHAR)"


_PROMPT_BODY = " || ',\n' || ".join(
    [
        "'  \"symbol\": ' || coalesce('\"' || symbol || '\"', 'null')",
        *[
            f"'  \"{name}\": ' || {_json_number(name)}"
            for name in ("price_usd", "volume_24h", "market_cap", "percent_change_24h")
        ],
        "'  \"news_headline\": ' || coalesce('\"' || news_headline || '\"', 'null')",
    ]
)

ORACLE = {
    "decode_envelope": f"""WITH {_PUSHED}
SELECT message_id, read_symbol AS symbol, resolved_source AS source, publish_time, error FROM named""",
    "ingest_bronze": f"""WITH {_PUSHED}
SELECT message_id AS id, read_symbol AS symbol, resolved_source AS source, as_of AS ingested_at,
       CASE WHEN k <> 5 THEN {sql.rounded(_SCORE, 6)} END AS sentiment_score,
       CASE WHEN k = 5 THEN 'Analysis error: no percent_change_24h'
            ELSE '24h change ' || CAST(percent_change_24h AS VARCHAR) || '%' END AS sentiment_reasoning,
       '2.0.0' AS function_version, CASE WHEN with_vector THEN 'true' ELSE 'false' END AS indexed,
       publish_time
FROM named WHERE error IS NULL""",
    "ingest_vectors": f"""WITH {_PUSHED}
SELECT 'market-data' AS namespace, message_id AS id, upper(symbol) AS symbol,
       CASE WHEN k = 5 THEN 'feed' ELSE 'unknown' END AS source,
       CASE WHEN k = 5 THEN 'NEUTRAL' WHEN {_SCORE} >= 7 THEN 'BULLISH'
            WHEN {_SCORE} < 4 THEN 'BEARISH' ELSE 'NEUTRAL' END AS sentiment_category,
       CASE WHEN k = 5 THEN 0 ELSE price_usd END AS price_usd,
       CASE WHEN k = 5 THEN '' ELSE coalesce(news_headline, '') END AS news_headline
FROM named WHERE with_vector""",
    "dead_letters": f"""WITH {_PUSHED}
SELECT CASE k WHEN 1 THEN '' WHEN 2 THEN '@@@' WHEN 3 THEN to_base64(encode(opening))
            ELSE to_base64(encode('[1]')) END AS original_message,
       error, {_STAMP} AS timestamp, 'market-data' AS topic
FROM named WHERE error IS NOT NULL""",
    "decode_json": f"""WITH {sql.MESSAGES}
SELECT CASE WHEN k = 17 THEN to_base64(unhex('FFFE41')) ELSE '[]' END AS original_message,
       {_BAD} AS error, {_STAMP} AS timestamp, 'market-data' AS topic
FROM messages WHERE k IN (17, 19)""",
    "typed_message": f"""WITH {sql.MESSAGES}
SELECT CASE WHEN k <> 13 THEN id END AS id, event_type AS symbol,
       CASE WHEN k % 5 = 0 THEN 0 WHEN k % 5 = 1 THEN NULL ELSE value END AS price_usd,
       CAST(k AS DOUBLE) AS volume_24h, CAST(0 AS DOUBLE) AS market_cap,
       CAST(0 AS DOUBLE) AS percent_change_24h, CAST(NULL AS VARCHAR) AS news_headline,
       CASE WHEN k % 2 = 0 THEN 'src' || k ELSE 'unknown' END AS source,
       CASE WHEN k % 3 <> 0 THEN '2024-01-01T00:00:00' ELSE {_STAMP} END AS timestamp,
       CASE WHEN k = 13 THEN 'missing id' END AS error
FROM messages WHERE k NOT IN (17, 19)""",
    "handled_messages": f"""WITH {sql.MESSAGES}
SELECT id, symbol, price_usd,
       CASE WHEN symbol IS NULL OR NOT price_usd > 50 THEN 'Handler returned failure' END AS error
FROM messages""",
    "publish_rows": f"""WITH {sql.MESSAGES}
SELECT symbol AS key,
       '{{"id":"' || id || '","symbol":' || coalesce('"' || symbol || '"', 'null')
       || ',"news_headline":' || coalesce('"' || news_headline || '"', 'null')
       || ',"source":"' || source || '","user_id":' || user_id || '}}' AS value
FROM messages""",
    "route_failures": f"""WITH {sql.MESSAGES}
SELECT id, CASE WHEN k % 4 < 2 THEN k % 4 + 2 ELSE k % 4 + 1 END AS attempt,
       CASE k % 4 WHEN 0 THEN as_of + INTERVAL 10 SECOND WHEN 1 THEN as_of + INTERVAL 20 SECOND END AS next_try,
       CASE WHEN k % 4 < 2 THEN 'retry' ELSE 'dead' END AS route
FROM messages""",
    "expire": """
SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOUR""",
    "parse_score_reply": f"""WITH {sql.MESSAGES}
SELECT event_id,
       CASE k % 10 WHEN 4 THEN 7 WHEN 5 THEN 5 WHEN 8 THEN 10
                   WHEN 9 THEN greatest(CAST(1 AS DOUBLE), k / CAST(10 AS DOUBLE)) END AS score,
       CASE k % 10 WHEN 2 THEN 'Parse error: reply is not JSON'
                   WHEN 3 THEN 'Analysis error: reply is not an object'
                   WHEN 4 THEN 'text' WHEN 5 THEN 'no score'
                   WHEN 6 THEN 'Analysis error: score is not a number'
                   WHEN 7 THEN 'Analysis error: score is not a number'
                   WHEN 8 THEN '' WHEN 9 THEN 'k=' || k END AS reasoning
FROM messages""",
    "clamp_score": f"""WITH {sql.MESSAGES}
SELECT event_id,
       CASE WHEN k % 10 <> 0 THEN greatest(CAST(1 AS DOUBLE), least(CAST(10 AS DOUBLE), value / 50)) END AS score,
       CASE WHEN k % 10 = 0 OR value = 0 THEN 'NEUTRAL' WHEN value / 50 >= 7 THEN 'BULLISH'
            WHEN value / 50 >= 4 THEN 'NEUTRAL' ELSE 'BEARISH' END AS category
FROM messages""",
    "searchable_text": f"""WITH {sql.MESSAGES}
SELECT id, {_text('volume_24h', 'percent_change_24h', 'sentiment_reasoning')} AS text FROM messages""",
    "searchable_text_news": """
SELECT doc_id, concat_ws(' | ', 'Cryptocurrency: ' || upper(lang),
         CASE WHEN n_chars <> 0 THEN 'Price: $' || format('{:,.2f}', CAST(n_chars AS DOUBLE)) END,
         'News: ' || source,
         CASE WHEN text <> '' THEN 'Content: ' || substring(text, 1, 500) END) AS text
FROM documents""",
    "payload_text": f"""WITH {sql.MESSAGES}
SELECT id, CASE WHEN k % 7 <> 0 THEN
       {_text('price_usd', 'percent_change_24h', 'sentiment_reasoning')} END AS text FROM messages""",
    "prompt_text": f"""WITH {sql.MESSAGES}
SELECT id, '{_PROMPT_HEAD}' || '{{\n' || {_PROMPT_BODY} || '\n}}' || '{_PROMPT_TAIL}' AS prompt
FROM messages""",
    "stable_key": f"""WITH {sql.MESSAGES}
SELECT id, 'lake:sentiment:' || k || ':hours=24:symbol=' || coalesce(symbol, 'None') AS key
FROM messages""",
    "short_hash": f"""WITH {sql.MESSAGES}
SELECT id, substring(sha256('{{"k": ' || k || ', "symbol": ' || coalesce('"' || symbol || '"', 'null')
       || ', "user_id": ' || user_id || '}}'), 1, 16) AS hash
FROM messages""",
}
