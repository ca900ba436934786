from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality

BRONZE = (
    "id string, raw_payload string, source string, ingested_at timestamp_ntz, "
    "sentiment_score double, sentiment_reasoning string, processing_metadata string"
)
NOW = datetime(2024, 1, 1)


def bronze_row(ident, score=5.0, payload="{}"):
    return (ident, payload, "s", NOW, score, "r", "{}")


def by_check(df):
    return {(r.expectation_type, r.column): r for r in df.collect()}


def test_bronze_suite(frame):
    rows = [bronze_row("a"), bronze_row("a"), bronze_row("b"), bronze_row(None)]
    results = by_check(quality.validate(frame(rows, BRONZE), "bronze_raw_data_suite"))
    assert results["expect_table_columns_to_match_ordered_list", None].success
    null = results["expect_column_values_to_not_be_null", "id"]
    assert (null.success, null.unexpected_count, null.unexpected_percent) == (False, 1, 25.0)
    unique = results["expect_column_values_to_be_unique", "id"]
    # Nulls are not compared; both rows of the repeated id count.
    assert (unique.success, unique.element_count, unique.unexpected_count) == (False, 4, 2)


def test_column_order_matters(frame):
    df = frame([bronze_row("a")], BRONZE)
    swapped = df.select(*reversed(df.columns))
    results = by_check(quality.validate(swapped, "bronze_raw_data_suite"))
    assert not results["expect_table_columns_to_match_ordered_list", None].success


def test_fractional_scores_fail_the_value_set(frame):
    df = frame([bronze_row("a", 7.5), bronze_row("b", 7.0)], BRONZE)
    results = quality.validate(quality.scored(df), "sentiment_validation_suite")
    success = {r.expectation_type: r.success for r in results.collect()}
    assert success == {
        "expect_column_values_to_be_between": True,
        "expect_column_distinct_values_to_be_in_set": False,
        "expect_column_pair_values_A_to_be_greater_than_B": True,
    }
    statistics = quality.suite_statistics(results).first()
    assert (statistics.evaluated_expectations, statistics.successful_expectations) == (3, 2)
    assert statistics.success_percent == pytest.approx(200 / 3)


@pytest.mark.parametrize("bad, passes", [(1, True), (2, False)])
def test_mostly_is_a_share_of_present_values(frame, bad, passes):
    prices = [1.0] * (100 - bad) + [-1.0] * bad + [None] * 50
    df = frame([(p,) for p in prices], "price_usd double")
    check = quality.between("price_usd", 0, 1e9, mostly=0.99)
    row = quality.validate(df, [check]).first()
    assert (row.success, row.element_count, row.unexpected_count) == (passes, 150, bad)
    assert row.unexpected_percent == float(bad)


def test_empty_table_passes(frame):
    results = quality.validate(frame([], "symbol string, price_usd double"), [
        quality.not_null("symbol"), quality.unique("symbol"), quality.between("price_usd", 0, 1)
    ])
    assert all(r.success for r in results.collect())


def test_row_wise_checks_share_one_scan(frame):
    schema = "symbol string, price_usd double, percent_change_24h double"
    df = frame([("btc", 1.0, 1.0)], schema)
    plan = quality.validate(df, "market_data_suite")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1


def test_reasoning_goes_with_a_score(frame):
    rows = [(5.0, None), (None, None), (5.0, "r")]
    df = frame(rows, "sentiment_score double, sentiment_reasoning string")
    row = quality.validate(df, [quality.accompanied("sentiment_score", "sentiment_reasoning")]).first()
    assert (row.success, row.unexpected_count) == (False, 1)


def test_checkpoint_and_log(frame, spark, tmp_path):
    good = frame([bronze_row("a"), bronze_row("b")], BRONZE)
    bad = frame([bronze_row("a"), bronze_row("a")], BRONZE)
    path = str(tmp_path / "log")
    for df in (good, bad):
        quality.log_validation(
            quality.run_checkpoint(df, "bronze_raw_data_suite", "cp", "bronze", NOW), path
        )
    log = {r.status: r for r in spark.read.parquet(path).collect()}
    assert log["passed"].success_percent == 100.0 and log["passed"].failed_count == 0
    # The log's row count is the number of evaluated checks.
    assert log["failed"].row_count == 5 and log["failed"].failed_count == 1
    assert "expect_column_values_to_be_unique" in log["failed"].failed_expectations


def test_failing_job_gives_an_error_row(frame):
    broken = frame([bronze_row("a")], BRONZE).withColumn("id", F.raise_error(F.lit("lost")).cast("string"))
    row = quality.run_checkpoint(broken, "bronze_raw_data_suite", "cp", "bronze", NOW).first()
    assert (row.status, row.success_percent, row.row_count) == ("error", 0.0, 0)


def test_gate(frame):
    good = quality.run_checkpoint(frame([bronze_row("a")], BRONZE), "bronze_raw_data_suite", "cp", "t", NOW)
    quality.require_passed(good)
    bad = quality.run_checkpoint(frame([bronze_row(None)], BRONZE), "bronze_raw_data_suite", "cp", "t", NOW)
    with pytest.raises(RuntimeError, match="cp failed"):
        quality.require_passed(bad)


def test_column_tests(frame):
    df = frame([("a", 1.0), ("a", 11.0), (None, None), ("b", 0.5)], "k string, v double")
    assert quality.failing_unique(df, "k").collect() == [("a", 2)]
    assert quality.failing_not_null(df, "k").count() == 1
    assert quality.failing_accepted_range(df, "v", 1, 10).count() == 2
    assert quality.failing_accepted_range(df, "v", low=1).count() == 1
    assert quality.failing_accepted_values(df, "k", ["a"]).collect() == [("b", 1)]
