"""Staging, gold and serving queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import gold, serving, staging
from tidemark.plans.storage import scratch_path
from tidemark.sources import refresh, tables
from workload import adapters, sql
from workload.adapters import bronze, table


def _staged(spark: SparkSession, sf_dir: str, hours: int | None = None):
    events = table(spark, sf_dir, "events")
    as_of = adapters.as_of(spark, sf_dir)
    return staging.stage_market_data(bronze(events), as_of, hours), as_of


def _hourly(spark: SparkSession, sf_dir: str, hours: int | None = None) -> DataFrame:
    staged, as_of = _staged(spark, sf_dir, hours)
    return gold.hourly_sentiment(staged, as_of)


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.latest_sentiment(_hourly(spark, sf_dir), "previous_hour")


def _history(spark: SparkSession, sf_dir: str, columns: str) -> DataFrame:
    staged, as_of = _staged(spark, sf_dir)
    hourly = gold.hourly_sentiment(staged, as_of)
    return serving.symbol_history(hourly, "Click", as_of, 48, columns)


def stg_market_data(spark, sf_dir):
    return _staged(spark, sf_dir)[0]


def stg_market_data_24h(spark, sf_dir):
    return _staged(spark, sf_dir, staging.LOOKBACK_HOURS)[0]


def silver_market_data(spark, sf_dir):
    return staging.silver_market_data(_staged(spark, sf_dir)[0])


def gold_hourly_sentiment(spark, sf_dir):
    return _hourly(spark, sf_dir)


def gold_hourly_sentiment_24h(spark, sf_dir):
    return _hourly(spark, sf_dir, staging.LOOKBACK_HOURS)


def gold_latest_sentiment(spark, sf_dir):
    return gold.latest_sentiment(_hourly(spark, sf_dir))


def gold_latest_prev_hour(spark, sf_dir):
    return _latest(spark, sf_dir)


def trend_history(spark, sf_dir):
    return gold.trend_history(_hourly(spark, sf_dir))


def trend_changes(spark, sf_dir):
    return gold.trend_changes(_hourly(spark, sf_dir))


def symbol_sentiment(spark, sf_dir):
    return serving.symbol_sentiment(_latest(spark, sf_dir), "purchase")


def symbol_history(spark, sf_dir):
    return _history(spark, sf_dir, "full")


def symbol_history_brief(spark, sf_dir):
    return _history(spark, sf_dir, "brief")


def history_payload(spark, sf_dir):
    return serving.history_payload(_history(spark, sf_dir, "full"))


def list_sentiments(spark, sf_dir):
    return serving.list_sentiments(_latest(spark, sf_dir))


def list_sentiments_neutral(spark, sf_dir):
    return serving.list_sentiments(_latest(spark, sf_dir), 3, "NEUTRAL")


def market_summary(spark, sf_dir):
    """The list is flattened to its symbols, to compare plain columns."""
    summary = serving.market_summary(_latest(spark, sf_dir))
    return summary.withColumn("symbols", F.array_join("symbols.symbol", ","))


def market_summary_top(spark, sf_dir):
    summary = serving.market_summary_top(_latest(spark, sf_dir))
    return summary.withColumns(
        {
            name: F.array_join(f"{name}.symbol", ",")
            for name in ("top_bullish", "top_bearish")
        }
    )


def top_per_category(spark, sf_dir):
    return serving.top_per_category(_latest(spark, sf_dir))


def response_violations(spark, sf_dir):
    return serving.response_violations(_latest(spark, sf_dir)).select("symbol")


def bronze_table(spark, sf_dir):
    """Last day of a written bronze table."""
    events = table(spark, sf_dir, "events")
    as_of = adapters.as_of(spark, sf_dir)
    path = scratch_path(spark, "bronze")
    tables.write_bronze(bronze(events), path)
    return tables.read_bronze(spark, path, as_of, 24).select(
        "id", "source", "ingested_at", "sentiment_score"
    )


def gold_views(spark, sf_dir):
    """Latest sentiment through the session views over written tables."""
    events = table(spark, sf_dir, "events")
    as_of = adapters.as_of(spark, sf_dir)
    bronze_path, hourly_path = scratch_path(spark, "bronze"), scratch_path(spark, "gold")
    tables.write_bronze(bronze(events), bronze_path)
    staged = staging.stage_market_data(
        tables.read_bronze(spark, bronze_path, as_of), as_of, None
    )
    tables.write_gold_hourly(gold.hourly_sentiment(staged, as_of), hourly_path)
    tables.create_views(
        spark, bronze_path, hourly_path, as_of, trend_mode="previous_hour"
    )
    return spark.table("gold_latest_sentiment")


def gold_incremental(spark, sf_dir):
    """The hourly table after two loads: all days but the newest, then the newest day.

    The second refresh rolls up that day alone.
    """
    as_of = adapters.as_of(spark, sf_dir)
    rows = bronze(table(spark, sf_dir, "events"))
    newest = F.col("ingested_at") >= F.to_date(F.lit(as_of).cast("timestamp_ntz"))
    bronze_path, path = scratch_path(spark, "bronze"), scratch_path(spark, "gold-parts")
    for load in (~newest | newest.isNull(), newest):
        tables.write_bronze(rows.filter(load), bronze_path)
        refresh.refresh_hourly(spark, bronze_path, path, as_of)
    return refresh.read_hourly(spark, path)


QUERIES = {
    f.__name__: f
    for f in (
        stg_market_data,
        stg_market_data_24h,
        silver_market_data,
        gold_hourly_sentiment,
        gold_hourly_sentiment_24h,
        gold_latest_sentiment,
        gold_latest_prev_hour,
        trend_history,
        trend_changes,
        symbol_sentiment,
        symbol_history,
        symbol_history_brief,
        history_payload,
        list_sentiments,
        list_sentiments_neutral,
        market_summary,
        market_summary_top,
        top_per_category,
        response_violations,
        bronze_table,
        gold_views,
        gold_incremental,
    )
}

_STAGED_SELECT = """
SELECT id, symbol, price_usd, volume_24h, market_cap, percent_change_24h,
       news_headline, sentiment_score, sentiment_reasoning, source, ingested_at,
       as_of AS processed_at, '2.0.0' AS function_version
FROM staged"""

_RECENT = "(SELECT * FROM staged WHERE ingested_at >= as_of - INTERVAL 24 HOUR)"

_TRENDS = """,
trends AS (
  SELECT symbol, hour_timestamp, avg_sentiment_score, previous AS prev_hour_sentiment,
         {trend} AS sentiment_trend
  FROM (SELECT *, lag(avg_sentiment_score) OVER (PARTITION BY symbol ORDER BY hour_timestamp) AS previous
        FROM hourly)
)""".format(trend=sql.TREND)

_HISTORY = """
FROM hourly
WHERE symbol = 'CLICK' AND hour_timestamp >= aggregated_at - INTERVAL 48 HOUR"""

_SUMMARY = """
SELECT count(*) AS total_symbols,
       count(*) FILTER (WHERE sentiment_category = 'BULLISH') AS bullish_count,
       count(*) FILTER (WHERE sentiment_category = 'NEUTRAL') AS neutral_count,
       count(*) FILTER (WHERE sentiment_category = 'BEARISH') AS bearish_count,
       max(last_updated) AS last_updated,
       {mean} AS avg_market_sentiment,
""".format(mean=sql.rounded("avg(sentiment_score)", 2))

ORACLE = {
    "stg_market_data": f"WITH {sql.STAGED} {_STAGED_SELECT}",
    "stg_market_data_24h": f"WITH {sql.STAGED} {_STAGED_SELECT} "
    "WHERE ingested_at >= as_of - INTERVAL 24 HOUR",
    "silver_market_data": f"""WITH {sql.STAGED}
SELECT id, symbol, price_usd, volume_24h, market_cap, percent_change_24h,
       sentiment_score, sentiment_reasoning, ingested_at, as_of AS processed_at
FROM staged""",
    "gold_hourly_sentiment": f"WITH {sql.hourly()} SELECT * FROM hourly",
    "gold_incremental": f"WITH {sql.hourly()} SELECT * FROM hourly",
    "gold_hourly_sentiment_24h": f"WITH {sql.hourly(_RECENT)} SELECT * FROM hourly",
    "gold_latest_sentiment": f"WITH {sql.LATEST} SELECT * FROM latest",
    "gold_latest_prev_hour": f"WITH {sql.LATEST_PREVIOUS} SELECT * FROM latest",
    "trend_history": f"WITH {sql.hourly()}{_TRENDS} SELECT * FROM trends",
    "trend_changes": f"""WITH {sql.hourly()}{_TRENDS}
SELECT * FROM (
  SELECT *, lag(sentiment_trend) OVER (PARTITION BY symbol ORDER BY hour_timestamp) AS previous_trend
  FROM trends)
WHERE sentiment_trend <> previous_trend""",
    "symbol_sentiment": f"WITH {sql.LATEST_PREVIOUS} SELECT * FROM latest WHERE upper(symbol) = 'PURCHASE' LIMIT 1",
    "symbol_history": f"""WITH {sql.hourly()}
SELECT hour_timestamp, symbol, avg_sentiment_score, sentiment_category, avg_price_usd,
       avg_percent_change_24h, avg_volume_24h, record_count {_HISTORY}""",
    "symbol_history_brief": f"""WITH {sql.hourly()}
SELECT hour_timestamp, symbol, avg_sentiment_score, sentiment_category, avg_price_usd,
       record_count {_HISTORY}""",
    "history_payload": f"""WITH {sql.hourly()}
SELECT hour_timestamp AS timestamp, avg_sentiment_score AS sentiment_score, sentiment_category,
       avg_price_usd AS price_usd, avg_percent_change_24h AS percent_change_24h,
       avg_volume_24h AS volume_24h, record_count {_HISTORY}""",
    "list_sentiments": f"""WITH {sql.LATEST_PREVIOUS}
SELECT * FROM latest ORDER BY sentiment_score DESC, symbol LIMIT 50""",
    "list_sentiments_neutral": f"""WITH {sql.LATEST_PREVIOUS}
SELECT * FROM latest WHERE sentiment_category = 'NEUTRAL'
ORDER BY sentiment_score DESC, symbol LIMIT 3""",
    "market_summary": f"""WITH {sql.LATEST_PREVIOUS} {_SUMMARY}
       string_agg(symbol, ',' ORDER BY sentiment_score DESC, symbol) AS symbols
FROM (SELECT * FROM latest ORDER BY sentiment_score DESC, symbol LIMIT 50)""",
    "market_summary_top": f"""WITH {sql.LATEST_PREVIOUS},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY sentiment_category ORDER BY
           CASE WHEN sentiment_category = 'BULLISH' THEN -sentiment_score ELSE sentiment_score END, symbol) AS place
  FROM (SELECT * FROM latest ORDER BY sentiment_score DESC, symbol LIMIT 100)
) {_SUMMARY}
       coalesce(string_agg(symbol, ',' ORDER BY place)
         FILTER (WHERE sentiment_category = 'BULLISH' AND place <= 5), '') AS top_bullish,
       coalesce(string_agg(symbol, ',' ORDER BY place)
         FILTER (WHERE sentiment_category = 'BEARISH' AND place <= 5), '') AS top_bearish
FROM ranked""",
    "top_per_category": f"""WITH {sql.LATEST_PREVIOUS}
SELECT sentiment_category, CAST(position AS INTEGER) AS position, symbol, sentiment_score FROM (
  SELECT sentiment_category,
         row_number() OVER (PARTITION BY sentiment_category ORDER BY
           CASE WHEN sentiment_category = 'BULLISH' THEN -sentiment_score ELSE sentiment_score END, symbol) AS position,
         symbol, sentiment_score
  FROM latest WHERE sentiment_category IN ('BULLISH', 'BEARISH'))
WHERE position <= 5""",
    "bronze_table": f"""WITH {sql.MESSAGES}
SELECT id, source, ingested_at, sentiment_score FROM messages
WHERE ingested_at >= as_of - INTERVAL 24 HOUR""",
    "gold_views": f"WITH {sql.LATEST_PREVIOUS} SELECT * FROM latest",
    "response_violations": f"""WITH {sql.LATEST_PREVIOUS}
SELECT symbol FROM latest
WHERE symbol IS NULL OR sentiment_score IS NULL OR sentiment_category IS NULL
   OR data_points IS NULL OR last_updated IS NULL
   OR NOT sentiment_score BETWEEN 1 AND 10""",
}
