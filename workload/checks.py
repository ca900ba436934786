"""Data-quality queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import gate, gold, idledger, quality, staging
from tidemark.plans.storage import scratch_path
from workload import adapters, sql
from workload.adapters import bronze, table


def _redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze in which every error event was delivered twice."""
    events = table(spark, sf_dir, "events")
    again = events.filter(F.col("event_type") == "error")
    return bronze(events.unionByName(again))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    as_of = adapters.as_of(spark, sf_dir)
    staged = staging.stage_market_data(bronze(events), as_of, None)
    return staging.silver_market_data(staged)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(bronze(table(spark, sf_dir, "events")))


def dq_bronze(spark, sf_dir):
    return quality.validate(_redelivered(spark, sf_dir), "bronze_raw_data_suite")


def dq_sentiment(spark, sf_dir):
    return quality.validate(_scored(spark, sf_dir), "sentiment_validation_suite")


def dq_market(spark, sf_dir):
    return quality.validate(_silver(spark, sf_dir), "market_data_suite")


def dq_reasoning(spark, sf_dir):
    check = quality.accompanied("sentiment_score", "sentiment_reasoning")
    return quality.validate(bronze(table(spark, sf_dir, "events")), [check])


def dq_statistics(spark, sf_dir):
    results = (
        dq_bronze(spark, sf_dir)
        .unionByName(dq_sentiment(spark, sf_dir))
        .unionByName(dq_market(spark, sf_dir))
    )
    return quality.suite_statistics(results)


def checkpoint_log(spark, sf_dir):
    """Log row without the run's own id and duration."""
    events = table(spark, sf_dir, "events")
    run_time = datetime.fromisoformat(adapters.as_of(spark, sf_dir))
    return quality.run_checkpoint(
        _scored(spark, sf_dir),
        "sentiment_validation_suite",
        "sentiment_checkpoint",
        "bronze_raw_data",
        run_time,
    ).select(
        "checkpoint_name",
        "status",
        F.round("success_percent", 4).alias("success_percent"),
        "failed_count",
        "table_name",
        "row_count",
        F.get_json_object("metadata", "$.rows_scanned")
        .cast("bigint")
        .alias("rows_scanned"),
    )


def failing_unique(spark, sf_dir):
    return quality.failing_unique(_redelivered(spark, sf_dir), "id")


def failing_not_null(spark, sf_dir):
    """Bronze rows without a score."""
    rows = bronze(table(spark, sf_dir, "events"))
    return quality.failing_not_null(rows, "sentiment_score").select("id", "source")


def failing_accepted_range(spark, sf_dir):
    """Staged rows with a change outside plus or minus four percent."""
    rows = quality.failing_accepted_range(
        _silver(spark, sf_dir), "percent_change_24h", -4, 4
    )
    return rows.select("id", "symbol", "percent_change_24h")


def failing_accepted_values(spark, sf_dir):
    return quality.failing_accepted_values(
        _silver(spark, sf_dir), "symbol", ["click", "view", "purchase"]
    )


def out_of_range_scores(spark, sf_dir):
    return quality.out_of_range_scores(_silver(spark, sf_dir))


def model_tests(spark, sf_dir):
    """Failing rows of every declared model test, over all four models."""
    events = table(spark, sf_dir, "events")
    as_of = adapters.as_of(spark, sf_dir)
    staged = staging.stage_market_data(bronze(events), as_of, None)
    hourly = gold.hourly_sentiment(staged, as_of)
    return (
        quality.model_tests(_redelivered(spark, sf_dir), "bronze_raw_data")
        .unionByName(quality.model_tests(staged, "stg_market_data"))
        .unionByName(quality.model_tests(hourly, "gold_hourly_sentiment"))
        .unionByName(
            quality.model_tests(gold.latest_sentiment(hourly), "gold_latest_sentiment")
        )
    )


def unique_over_appends(spark, sf_dir):
    """Repeated ids from a ledger that was fed the same rows in three appends."""
    rows, path = _redelivered(spark, sf_dir), scratch_path(spark, "id-ledger")
    part = F.coalesce(F.dayofyear("ingested_at") % 3, F.lit(0))
    for number in range(3):
        idledger.append_values(rows.filter(part == number), "id", path, str(number))
    return idledger.repeated_values(spark, path, "id")


def gated_append(spark, sf_dir):
    """Three loads through the gate: the second holds redelivered messages and stays out.

    One row per load, as read back from the log, with the rows it added to the table.
    """
    plain = bronze(table(spark, sf_dir, "events"))
    path, log = scratch_path(spark, "gated"), scratch_path(spark, "gate-log")
    run_time = datetime.fromisoformat(adapters.as_of(spark, sf_dir))
    suite = [quality.not_null("id"), quality.unique("id"), quality.between("sentiment_score", 1, 10)]
    part = F.coalesce(F.dayofyear("ingested_at") % 3, F.lit(0))
    for number, rows in enumerate((plain, _redelivered(spark, sf_dir), plain)):
        load = rows.filter(part == number)
        logged = gate.append_checked(load, path, suite, f"load-{number}", "gated", run_time)
        quality.log_validation(logged, log)
    published = gate.read_checked(spark, path, plain.schema).groupBy(
        F.concat(F.lit("load-"), part).alias("checkpoint_name")
    )
    return (
        spark.read.parquet(log)
        .join(published.count(), "checkpoint_name", "left")
        .select(
            "checkpoint_name",
            "status",
            "failed_count",
            F.get_json_object("metadata", "$.rows_scanned").cast("bigint").alias("rows_scanned"),
            F.coalesce("count", F.lit(0)).alias("published_rows"),
        )
    )


QUERIES = {
    f.__name__: f
    for f in (
        dq_bronze,
        dq_sentiment,
        dq_market,
        dq_reasoning,
        dq_statistics,
        checkpoint_log,
        failing_unique,
        unique_over_appends,
        gated_append,
        failing_not_null,
        failing_accepted_range,
        failing_accepted_values,
        out_of_range_scores,
        model_tests,
    )
}

_REDELIVERED = sql.MESSAGES + """,
bronze AS (SELECT * FROM messages UNION ALL SELECT * FROM messages WHERE event_type = 'error'),
copies AS (SELECT id, count(*) AS n FROM bronze GROUP BY id)"""


def _check(
    kind: str, column: str, kwargs: str, seen: str, bad: str, mostly: str, source: str
) -> str:
    """One result row: ``seen`` and ``bad`` are counts over ``source``."""
    return f"""
SELECT '{kind}' AS expectation_type, '{column}' AS "column", '{kwargs}' AS kwargs,
       seen = 0 OR seen - bad >= seen * {mostly} AS success,
       element_count, bad AS unexpected_count,
       CASE WHEN seen > 0 THEN bad * CAST(100 AS DOUBLE) / seen END AS unexpected_percent,
       CAST(NULL AS VARCHAR) AS observed_value
FROM (SELECT count(*) AS element_count, {seen} AS seen, {bad} AS bad FROM {source})"""


def _null_check(column: str, source: str) -> str:
    return _check(
        "expect_column_values_to_not_be_null",
        column,
        f'{{"column": "{column}"}}',
        "count(*)",
        f"count(*) FILTER (WHERE {column} IS NULL)",
        "1",
        source,
    )


_PAYLOAD_ROWS = "(SELECT *, '{}' AS raw_payload FROM bronze)"
_COLUMN_LIST = (
    '["id", "raw_payload", "source", "ingested_at", '
    '"sentiment_score", "sentiment_reasoning", "processing_metadata"]'
)
_BRONZE_CHECKS = " UNION ALL ".join(
    [
        f"""
SELECT 'expect_table_columns_to_match_ordered_list' AS expectation_type,
       CAST(NULL AS VARCHAR) AS "column", '{{"column_list": {_COLUMN_LIST}}}' AS kwargs,
       true AS success, CAST(NULL AS BIGINT) AS element_count,
       CAST(NULL AS BIGINT) AS unexpected_count, CAST(NULL AS DOUBLE) AS unexpected_percent,
       '{_COLUMN_LIST}' AS observed_value""",
        _null_check("id", "bronze"),
        """
SELECT 'expect_column_values_to_be_unique', 'id', '{"column": "id"}',
       bad = 0, total, bad, bad * CAST(100 AS DOUBLE) / total, NULL
FROM (SELECT CAST(sum(n) AS BIGINT) AS total,
             CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS bad FROM copies)""",
        _null_check("raw_payload", _PAYLOAD_ROWS),
        _null_check("ingested_at", "bronze"),
    ]
)
_SCORED = "(SELECT * FROM messages WHERE sentiment_score IS NOT NULL)"
_SENTIMENT_CHECKS = " UNION ALL ".join(
    [
        _check(
            "expect_column_values_to_be_between",
            "sentiment_score",
            '{"column": "sentiment_score", "min_value": 1.0, "max_value": 10.0, "mostly": 1.0}',
            "count(sentiment_score)",
            "count(*) FILTER (WHERE sentiment_score NOT BETWEEN 1 AND 10)",
            "1",
            _SCORED,
        ),
        _check(
            "expect_column_distinct_values_to_be_in_set",
            "sentiment_score",
            '{"column": "sentiment_score", "value_set": [1, 2, 3, 4, 5, 6, 7, 8, 9, 10]}',
            "count(sentiment_score)",
            "count(*) FILTER (WHERE sentiment_score NOT IN (1, 2, 3, 4, 5, 6, 7, 8, 9, 10))",
            "1",
            _SCORED,
        ),
        _check(
            "expect_column_pair_values_A_to_be_greater_than_B",
            "sentiment_score",
            '{"column_A": "sentiment_score", "column_B": "sentiment_score", "or_equal": true}',
            "count(sentiment_score)",
            "count(*) FILTER (WHERE sentiment_score < sentiment_score)",
            "1",
            _SCORED,
        ),
    ]
)
_MARKET_CHECKS = " UNION ALL ".join(
    [
        _null_check("symbol", "staged"),
        _check(
            "expect_column_value_lengths_to_be_between",
            "symbol",
            '{"column": "symbol", "min_value": 2, "max_value": 10}',
            "count(symbol)",
            "count(*) FILTER (WHERE length(symbol) NOT BETWEEN 2 AND 10)",
            "1",
            "staged",
        ),
        _check(
            "expect_column_values_to_be_between",
            "price_usd",
            '{"column": "price_usd", "min_value": 0, "max_value": 1000000000, "mostly": 0.99}',
            "count(price_usd)",
            "count(*) FILTER (WHERE price_usd NOT BETWEEN 0 AND 1000000000)",
            "0.99",
            "staged",
        ),
        _check(
            "expect_column_values_to_be_between",
            "percent_change_24h",
            '{"column": "percent_change_24h", "min_value": -100, "max_value": 10000, "mostly": 0.99}',
            "count(percent_change_24h)",
            "count(*) FILTER (WHERE percent_change_24h NOT BETWEEN -100 AND 10000)",
            "0.99",
            "staged",
        ),
    ]
)
_ALL_CTES = _REDELIVERED + ", staged AS (SELECT * FROM messages WHERE symbol IS NOT NULL)"


def _test(model: str, column: str, test: str, failures: str, source: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{column}' AS \"column\", '{test}' AS test, "
        f"{failures} AS failures FROM {source}"
    )


def _failing(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def _repeated(column: str, source: str) -> str:
    return f"(SELECT {column} FROM {source} GROUP BY 1 HAVING count(*) > 1)"


_MODEL_TESTS = " UNION ALL ".join(
    [
        _test("bronze_raw_data", "id", "unique", "count(*)", _repeated("id", "bronze")),
        _test("bronze_raw_data", "id", "not_null", _failing("id IS NULL"), "bronze"),
        _test("bronze_raw_data", "raw_payload", "not_null", _failing("false"), "bronze"),
        _test(
            "bronze_raw_data", "ingested_at", "not_null", _failing("ingested_at IS NULL"), "bronze"
        ),
        _test("stg_market_data", "id", "unique", "count(*)", _repeated("id", "staged")),
        _test("stg_market_data", "id", "not_null", _failing("id IS NULL"), "staged"),
        _test("stg_market_data", "symbol", "not_null", _failing("symbol IS NULL"), "staged"),
        _test(
            "stg_market_data",
            "sentiment_score",
            "accepted_range",
            _failing("sentiment_score NOT BETWEEN 1 AND 10"),
            "staged",
        ),
        _test(
            "stg_market_data", "ingested_at", "not_null", _failing("ingested_at IS NULL"), "staged"
        ),
        _test(
            "gold_hourly_sentiment",
            "hour_timestamp",
            "not_null",
            _failing("hour_timestamp IS NULL"),
            "hourly",
        ),
        _test("gold_hourly_sentiment", "symbol", "not_null", _failing("symbol IS NULL"), "hourly"),
        _test(
            "gold_hourly_sentiment",
            "avg_sentiment_score",
            "not_null",
            _failing("avg_sentiment_score IS NULL"),
            "hourly",
        ),
        _test(
            "gold_hourly_sentiment",
            "avg_sentiment_score",
            "accepted_range",
            _failing("avg_sentiment_score NOT BETWEEN 1 AND 10"),
            "hourly",
        ),
        _test(
            "gold_hourly_sentiment",
            "sentiment_category",
            "accepted_values",
            _failing("sentiment_category NOT IN ('BULLISH', 'NEUTRAL', 'BEARISH')"),
            "hourly",
        ),
        _test(
            "gold_hourly_sentiment",
            "record_count",
            "accepted_range",
            _failing("record_count < 1"),
            "hourly",
        ),
        _test(
            "gold_latest_sentiment", "symbol", "unique", "count(*)", _repeated("symbol", "latest")
        ),
        _test("gold_latest_sentiment", "symbol", "not_null", _failing("symbol IS NULL"), "latest"),
        _test(
            "gold_latest_sentiment",
            "sentiment_score",
            "accepted_range",
            _failing("sentiment_score NOT BETWEEN 1 AND 10"),
            "latest",
        ),
        _test(
            "gold_latest_sentiment",
            "last_updated",
            "not_null",
            _failing("last_updated IS NULL"),
            "latest",
        ),
    ]
)

ORACLE = {
    "dq_bronze": f"WITH {_REDELIVERED} {_BRONZE_CHECKS}",
    "dq_sentiment": f"WITH {sql.MESSAGES} {_SENTIMENT_CHECKS}",
    "dq_market": f"WITH {sql.STAGED} {_MARKET_CHECKS}",
    "dq_reasoning": f"WITH {sql.MESSAGES} "
    + _check(
        "expect_companion_present",
        "sentiment_score",
        '{"column": "sentiment_score", "companion": "sentiment_reasoning"}',
        "count(sentiment_score)",
        "count(*) FILTER (WHERE sentiment_score IS NOT NULL AND sentiment_reasoning IS NULL)",
        "1",
        "messages",
    ),
    "dq_statistics": f"""WITH {_ALL_CTES}
SELECT count(*) AS evaluated_expectations,
       count(*) FILTER (WHERE success) AS successful_expectations,
       count(*) FILTER (WHERE NOT success) AS unsuccessful_expectations,
       count(*) FILTER (WHERE success) * CAST(100 AS DOUBLE) / count(*) AS success_percent
FROM ({_BRONZE_CHECKS} UNION ALL {_SENTIMENT_CHECKS} UNION ALL {_MARKET_CHECKS})""",
    "checkpoint_log": f"""WITH {sql.MESSAGES}
SELECT 'sentiment_checkpoint' AS checkpoint_name,
       CASE WHEN bool_and(success) THEN 'passed' ELSE 'failed' END AS status,
       round(count(*) FILTER (WHERE success) * CAST(100 AS DOUBLE) / count(*), 4) AS success_percent,
       count(*) FILTER (WHERE NOT success) AS failed_count,
       'bronze_raw_data' AS table_name, count(*) AS row_count, max(element_count) AS rows_scanned
FROM ({_SENTIMENT_CHECKS})""",
    "failing_unique": f"WITH {_REDELIVERED} SELECT id, n AS n_records FROM copies WHERE n > 1",
    "unique_over_appends": f"WITH {_REDELIVERED} SELECT id, n AS n_records FROM copies WHERE n > 1",
    "gated_append": f"""WITH {sql.MESSAGES},
loads AS (
  SELECT id, coalesce(dayofyear(ingested_at) % 3, 0) AS part FROM messages
  UNION ALL
  SELECT id, 1 FROM messages WHERE event_type = 'error' AND dayofyear(ingested_at) % 3 = 1),
judged AS (
  SELECT n, count(id) AS seen, count(id) > count(DISTINCT id) AS repeats
  FROM range(3) AS r(n) LEFT JOIN loads ON part = n GROUP BY n)
SELECT 'load-' || n AS checkpoint_name,
       CASE WHEN repeats THEN 'failed' ELSE 'passed' END AS status,
       CASE WHEN repeats THEN 1 ELSE 0 END AS failed_count,
       seen AS rows_scanned,
       CASE WHEN repeats THEN 0 ELSE seen END AS published_rows
FROM judged""",
    "failing_not_null": f"WITH {sql.MESSAGES} SELECT id, source FROM messages WHERE sentiment_score IS NULL",
    "failing_accepted_range": f"""WITH {sql.STAGED}
SELECT id, symbol, percent_change_24h FROM staged WHERE percent_change_24h NOT BETWEEN -4 AND 4""",
    "failing_accepted_values": f"""WITH {sql.STAGED}
SELECT symbol, count(*) AS n_records FROM staged
WHERE symbol NOT IN ('click', 'view', 'purchase') GROUP BY symbol""",
    "out_of_range_scores": f"""WITH {sql.STAGED}
SELECT id, symbol, sentiment_score, ingested_at FROM staged
WHERE sentiment_score < 1 OR sentiment_score > 10""",
    "model_tests": f"""WITH {sql.LATEST},
bronze AS (SELECT * FROM messages UNION ALL SELECT * FROM messages WHERE event_type = 'error')
{_MODEL_TESTS}""",
}
