"""SQL fragments shared by the counterpart statements."""

# Every event as a market message; mirrors workload.adapters.bronze.
MESSAGES = """
messages AS (
  SELECT 'evt-' || event_id AS id, event_id, user_id, event_type, value, k,
         CASE WHEN k <> 13 THEN event_type END AS symbol,
         value AS price_usd,
         value * k AS volume_24h,
         value * 1000 AS market_cap,
         (k - 50) / CAST(10 AS DOUBLE) AS percent_change_24h,
         CASE WHEN k % 2 <> 0 THEN event_type || ' moved' END AS news_headline,
         'src' || (user_id % 20) AS source,
         ts AS ingested_at,
         CASE WHEN k % 10 <> 0
              THEN greatest(CAST(1 AS DOUBLE), least(CAST(10 AS DOUBLE), 5 + (k - 50) / CAST(10 AS DOUBLE)))
         END AS sentiment_score,
         'k=' || k AS sentiment_reasoning,
         (SELECT max(ts) FROM events) AS as_of
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""

STAGED = MESSAGES + """,
staged AS (SELECT * FROM messages WHERE symbol IS NOT NULL)"""


def rounded(value: str, digits: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38,9)), {digits}) AS DOUBLE)"


def hourly(source: str = "staged") -> str:
    """CTEs up to ``hourly``, the hourly gold table of ``source``."""
    return STAGED + f""",
hourly AS (
  SELECT date_trunc('hour', ingested_at) AS hour_timestamp,
         upper(symbol) AS symbol,
         {rounded('avg(sentiment_score)', 2)} AS avg_sentiment_score,
         {rounded('min(sentiment_score)', 2)} AS min_sentiment_score,
         {rounded('max(sentiment_score)', 2)} AS max_sentiment_score,
         {rounded('stddev_samp(sentiment_score)', 2)} AS sentiment_stddev,
         CASE WHEN CAST(avg(sentiment_score) AS DECIMAL(38,9)) >= 7 THEN 'BULLISH'
              WHEN CAST(avg(sentiment_score) AS DECIMAL(38,9)) >= 4 THEN 'NEUTRAL'
              ELSE 'BEARISH' END AS sentiment_category,
         {rounded('avg(price_usd)', 2)} AS avg_price_usd,
         {rounded('min(price_usd)', 2)} AS min_price_usd,
         {rounded('max(price_usd)', 2)} AS max_price_usd,
         {rounded('avg(volume_24h)', 0)} AS avg_volume_24h,
         {rounded('sum(volume_24h)', 0)} AS total_volume_24h,
         {rounded('avg(percent_change_24h)', 2)} AS avg_percent_change_24h,
         count(*) AS record_count,
         count(DISTINCT source) AS source_count,
         list(sentiment_reasoning ORDER BY ingested_at DESC, id DESC)[1] AS latest_reasoning,
         max(as_of) AS aggregated_at
  FROM {source}
  WHERE sentiment_score IS NOT NULL
  GROUP BY 1, 2
)"""


LATEST_COLUMNS = """
  symbol, hour_timestamp AS last_updated, avg_sentiment_score AS sentiment_score,
  sentiment_category, {trend} AS sentiment_trend, avg_price_usd AS price_usd,
  avg_percent_change_24h AS percent_change_24h, avg_volume_24h AS volume_24h,
  record_count AS data_points, latest_reasoning AS ai_reasoning"""

TREND = """CASE WHEN avg_sentiment_score > previous THEN 'IMPROVING'
       WHEN avg_sentiment_score < previous THEN 'DECLINING' ELSE 'STABLE' END"""

LATEST = hourly() + f""",
latest AS (
  SELECT {LATEST_COLUMNS.format(trend="'STABLE'")}
  FROM hourly
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY hour_timestamp DESC) = 1
)"""

LATEST_PREVIOUS = hourly() + f""",
compared AS (
  SELECT *, lag(avg_sentiment_score) OVER (PARTITION BY symbol ORDER BY hour_timestamp) AS previous,
         row_number() OVER (PARTITION BY symbol ORDER BY hour_timestamp DESC) AS age
  FROM hourly
),
latest AS (SELECT {LATEST_COLUMNS.format(trend=TREND)} FROM compared WHERE age = 1)"""
