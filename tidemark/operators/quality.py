"""Data-quality suites, column tests, checkpoints and the result log.

All row-wise checks of a suite are columns of one aggregation, so a suite costs
one scan; each uniqueness check adds one shuffle of a single column, combined
before it is sent.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.schemas import BRONZE, QUALITY_LOG

# Statuses of a checkpoint.
PASSED, FAILED, ERROR = "passed", "failed", "error"

@dataclass(frozen=True)
class Check:
    """One expectation: its public type name and arguments."""

    kind: str
    kwargs: dict[str, Any] = field(default_factory=dict)

    @property
    def column(self) -> str | None:
        return self.kwargs.get("column") or self.kwargs.get("column_A")

    @property
    def mostly(self) -> float:
        return self.kwargs.get("mostly", 1.0)


def columns_match(names: Sequence[str]) -> Check:
    return Check(
        "expect_table_columns_to_match_ordered_list", {"column_list": list(names)}
    )


def not_null(column: str) -> Check:
    return Check("expect_column_values_to_not_be_null", {"column": column})


def unique(column: str) -> Check:
    return Check("expect_column_values_to_be_unique", {"column": column})


def between(column: str, low: float, high: float, mostly: float = 1.0) -> Check:
    return Check(
        "expect_column_values_to_be_between",
        {"column": column, "min_value": low, "max_value": high, "mostly": mostly},
    )


def distinct_in_set(column: str, values: Iterable[float]) -> Check:
    return Check(
        "expect_column_distinct_values_to_be_in_set",
        {"column": column, "value_set": list(values)},
    )


def pair_ordered(column_a: str, column_b: str) -> Check:
    return Check(
        "expect_column_pair_values_A_to_be_greater_than_B",
        {"column_A": column_a, "column_B": column_b, "or_equal": True},
    )


def lengths_between(column: str, low: int, high: int) -> Check:
    return Check(
        "expect_column_value_lengths_to_be_between",
        {"column": column, "min_value": low, "max_value": high},
    )


def accompanied(column: str, companion: str) -> Check:
    """``companion`` is present wherever ``column`` is."""
    return Check("expect_companion_present", {"column": column, "companion": companion})


# The suites and their limits.
SUITES: dict[str, list[Check]] = {
    "bronze_raw_data_suite": [
        columns_match([f.name for f in BRONZE.fields]),
        not_null("id"),
        unique("id"),
        not_null("raw_payload"),
        not_null("ingested_at"),
    ],
    "sentiment_validation_suite": [
        between("sentiment_score", 1.0, 10.0),
        distinct_in_set("sentiment_score", range(1, 11)),
        pair_ordered("sentiment_score", "sentiment_score"),
    ],
    "market_data_suite": [
        not_null("symbol"),
        lengths_between("symbol", 2, 10),
        between("price_usd", 0, 1_000_000_000, mostly=0.99),
        between("percent_change_24h", -100, 10_000, mostly=0.99),
    ],
}


def _unexpected(check: Check) -> Column:
    """Row-wise condition of a value that breaks the check; nulls are judged by not_null."""
    args = check.kwargs
    value = F.col(check.column)
    match check.kind:
        case "expect_column_values_to_not_be_null":
            return value.isNull()
        case "expect_column_values_to_be_between":
            return ~value.between(args["min_value"], args["max_value"])
        case "expect_column_distinct_values_to_be_in_set":
            return ~value.isin(args["value_set"])
        case "expect_column_pair_values_A_to_be_greater_than_B":
            return ~F.coalesce(value >= F.col(args["column_B"]), F.lit(False))
        case "expect_column_value_lengths_to_be_between":
            return ~F.length(value).between(args["min_value"], args["max_value"])
        case "expect_companion_present":
            return F.col(args["companion"]).isNull()
    raise ValueError(f"unknown check {check.kind}")


def _counts_nulls(check: Check) -> bool:
    return check.kind == "expect_column_values_to_not_be_null"


def _relevant(check: Check) -> Column:
    """Rows a check looks at."""
    if _counts_nulls(check):
        return F.lit(True)
    if check.kind == "expect_column_pair_values_A_to_be_greater_than_B":
        return F.col(check.column).isNotNull() | F.col(check.kwargs["column_B"]).isNotNull()
    return F.col(check.column).isNotNull()


def _result(
    check: Check, elements: Column, looked_at: Column, unexpected: Column, observed: Column
) -> Column:
    percent = F.when(looked_at > 0, unexpected * 100.0 / looked_at)
    enough = (looked_at - unexpected) >= looked_at * check.mostly
    return F.struct(
        F.lit(check.kind).alias("expectation_type"),
        F.lit(check.column).cast("string").alias("column"),
        F.lit(json.dumps(check.kwargs)).alias("kwargs"),
        ((looked_at == 0) | enough).alias("success"),
        elements.alias("element_count"),
        unexpected.alias("unexpected_count"),
        percent.alias("unexpected_percent"),
        observed.cast("string").alias("observed_value"),
    )


def row_totals(checks: Sequence[Check]) -> list[Column]:
    """Counters of row-wise checks, for one aggregation or observation of a table."""
    totals = [F.count("*").alias("_rows")]
    for i, check in enumerate(checks):
        relevant = _relevant(check)
        totals.append(F.count_if(relevant).alias(f"_seen{i}"))
        totals.append(F.count_if(relevant & _unexpected(check)).alias(f"_bad{i}"))
    return totals


def row_results(totals: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One result row per check from the row of counters."""
    results = [
        _result(
            check,
            F.col("_rows"),
            F.col(f"_seen{i}"),
            F.col(f"_bad{i}"),
            F.lit(None),
        )
        for i, check in enumerate(checks)
    ]
    return totals.select(F.inline(F.array(*results)))


def _uniqueness(df: DataFrame, check: Check) -> DataFrame:
    """All rows sharing a value count as unexpected; nulls are not compared."""
    copies = df.groupBy(F.col(check.column).alias("_value")).agg(
        F.count("*").alias("_copies")
    )
    n = F.col("_copies")
    present = F.col("_value").isNotNull()
    totals = copies.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("_rows"),
        F.coalesce(F.sum(F.when(present, n)), F.lit(0)).alias("_seen"),
        F.coalesce(F.sum(F.when(present & (n > 1), n)), F.lit(0)).alias("_bad"),
    )
    row = _result(check, F.col("_rows"), F.col("_seen"), F.col("_bad"), F.lit(None))
    return totals.select(F.inline(F.array(row)))


def _columns(df: DataFrame, check: Check) -> DataFrame:
    nothing = F.lit(None).cast("bigint")
    row = F.struct(
        F.lit(check.kind).alias("expectation_type"),
        F.lit(None).cast("string").alias("column"),
        F.lit(json.dumps(check.kwargs)).alias("kwargs"),
        F.lit(df.columns == check.kwargs["column_list"]).alias("success"),
        nothing.alias("element_count"),
        nothing.alias("unexpected_count"),
        nothing.cast("double").alias("unexpected_percent"),
        F.lit(json.dumps(df.columns)).alias("observed_value"),
    )
    return df.sparkSession.range(1).select(F.inline(F.array(row)))


def validate(df: DataFrame, suite: str | Sequence[Check]) -> DataFrame:
    """One result row per check, over all rows."""
    row_wise, apart = split_suite(suite)
    parts = [judge(df, c) for c, judge in apart]
    if row_wise:
        parts.append(row_results(df.agg(*row_totals(row_wise)), row_wise))
    return reduce(DataFrame.unionByName, parts)


def split_suite(suite: str | Sequence[Check]) -> tuple[list[Check], list[tuple]]:
    """The row-wise checks of a suite, and the others with what judges them."""
    checks = SUITES[suite] if isinstance(suite, str) else list(suite)
    judges = {
        "expect_table_columns_to_match_ordered_list": _columns,
        "expect_column_values_to_be_unique": _uniqueness,
    }
    return (
        [c for c in checks if c.kind not in judges],
        [(c, judges[c.kind]) for c in checks if c.kind in judges],
    )


def scored(bronze: DataFrame) -> DataFrame:
    """Scored bronze rows, as the sentiment suite looks at them."""
    return bronze.select("sentiment_score", "sentiment_reasoning").filter(
        F.col("sentiment_score").isNotNull()
    )


def suite_statistics(results: DataFrame) -> DataFrame:
    """Evaluated, successful and unsuccessful checks with the success percentage."""
    good = F.count_if("success")
    return results.agg(
        F.count("*").alias("evaluated_expectations"),
        good.alias("successful_expectations"),
        F.count_if(~F.col("success")).alias("unsuccessful_expectations"),
        F.when(F.count("*") > 0, good * 100.0 / F.count("*")).alias("success_percent"),
    )


def run_checkpoint(
    df: DataFrame,
    suite: str | Sequence[Check],
    checkpoint_name: str,
    table_name: str,
    run_time: datetime,
) -> DataFrame:
    """Run a suite and return its one log row.

    Only the result rows, as many as the suite has checks, come to the driver.
    ``row_count`` holds the number of evaluated checks, as the log always has;
    the rows scanned are in the metadata. A failing job gives an error row.
    """
    return judged(
        df.sparkSession, lambda: validate(df, suite).collect(), checkpoint_name, table_name, run_time
    )


def judged(
    spark: SparkSession,
    judge: Callable[[], list[Row]],
    checkpoint_name: str,
    table_name: str,
    run_time: datetime,
) -> DataFrame:
    """The log row of a checkpoint whose result rows ``judge`` gives."""
    started = time.monotonic()
    try:
        results = judge()
    except Exception as error:
        row = (
            checkpoint_name,
            ERROR,
            0.0,
            1,
            json.dumps([{"error": str(error)}]),
            run_time,
            table_name,
            0,
            json.dumps({"error": str(error)}),
        )
        return spark.createDataFrame([row], QUALITY_LOG)
    failed = [
        {
            "expectation_type": r.expectation_type,
            "kwargs": json.loads(r.kwargs),
            "observed_value": r.observed_value,
        }
        for r in results
        if not r.success
    ]
    scanned = max((r.element_count or 0 for r in results), default=0)
    metadata = {
        "run_id": uuid.uuid4().hex,
        "duration_seconds": time.monotonic() - started,
        "rows_scanned": scanned,
    }
    row = (
        checkpoint_name,
        FAILED if failed else PASSED,
        100.0 * (len(results) - len(failed)) / len(results) if results else 0.0,
        len(failed),
        json.dumps(failed),
        run_time,
        table_name,
        len(results),
        json.dumps(metadata),
    )
    return spark.createDataFrame([row], QUALITY_LOG)


def log_validation(result: DataFrame, path: str) -> None:
    result.write.mode("append").parquet(path)


def require_passed(result: DataFrame) -> None:
    """Stop the job when a checkpoint did not pass."""
    row = result.first()
    if row.status != PASSED:
        raise RuntimeError(f"{row.checkpoint_name} {row.status}: {row.failed_expectations}")


# Column tests of the models: each returns the failing rows or values.


def failing_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def failing_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(_row_failure("not_null", column, {}))


def failing_accepted_range(
    df: DataFrame, column: str, low: float | None = None, high: float | None = None
) -> DataFrame:
    """Rows outside the range, its ends included; nulls pass."""
    return df.filter(_row_failure("accepted_range", column, {"low": low, "high": high}))


def failing_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the set, with their number of rows."""
    return (
        df.filter(_row_failure("accepted_values", column, {"values": list(values)}))
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
    )


def out_of_range_scores(staged: DataFrame) -> DataFrame:
    """Staged rows whose score lies outside 1 to 10; none is a pass."""
    return failing_accepted_range(staged, "sentiment_score", 1, 10).select(
        "id", "symbol", "sentiment_score", "ingested_at"
    )


# Column tests declared for each model.
MODEL_TESTS: dict[str, list[tuple[str, str, dict]]] = {
    "bronze_raw_data": [
        ("unique", "id", {}),
        ("not_null", "id", {}),
        ("not_null", "raw_payload", {}),
        ("not_null", "ingested_at", {}),
    ],
    "stg_market_data": [
        ("unique", "id", {}),
        ("not_null", "id", {}),
        ("not_null", "symbol", {}),
        ("accepted_range", "sentiment_score", {"low": 1, "high": 10}),
        ("not_null", "ingested_at", {}),
    ],
    "gold_hourly_sentiment": [
        ("not_null", "hour_timestamp", {}),
        ("not_null", "symbol", {}),
        ("not_null", "avg_sentiment_score", {}),
        ("accepted_range", "avg_sentiment_score", {"low": 1, "high": 10}),
        (
            "accepted_values",
            "sentiment_category",
            {"values": ["BULLISH", "NEUTRAL", "BEARISH"]},
        ),
        ("accepted_range", "record_count", {"low": 1}),
    ],
    "gold_latest_sentiment": [
        ("unique", "symbol", {}),
        ("not_null", "symbol", {}),
        ("accepted_range", "sentiment_score", {"low": 1, "high": 10}),
        ("not_null", "last_updated", {}),
    ],
}


def _row_failure(test: str, column: str, args: dict) -> Column:
    value = F.col(column)
    if test == "not_null":
        return value.isNull()
    if test == "accepted_values":
        return ~value.isin(args["values"])
    low, high = args.get("low"), args.get("high")
    bad = F.lit(False)
    if low is not None:
        bad = bad | (value < low)
    if high is not None:
        bad = bad | (value > high)
    return bad


def model_tests(df: DataFrame, model: str) -> DataFrame:
    """Failing rows of every test declared for a model: one scan plus one per unique test."""
    tests = MODEL_TESTS[model]
    row_wise = [t for t in tests if t[0] != "unique"]

    def line(test: str, column: str, failures: Column) -> Column:
        return F.struct(
            F.lit(model).alias("model"),
            F.lit(column).alias("column"),
            F.lit(test).alias("test"),
            failures.alias("failures"),
        )

    counted = df.agg(
        *[
            F.count_if(_row_failure(*t)).alias(f"_bad{i}")
            for i, t in enumerate(row_wise)
        ]
    ).select(
        F.inline(
            F.array(
                *[line(t[0], t[1], F.col(f"_bad{i}")) for i, t in enumerate(row_wise)]
            )
        )
    )
    parts = [counted]
    for test, column, _ in tests:
        if test == "unique":
            repeated = failing_unique(df, column).agg(F.count("*").alias("_bad"))
            parts.append(
                repeated.select(F.inline(F.array(line(test, column, F.col("_bad")))))
            )
    return reduce(DataFrame.unionByName, parts)
