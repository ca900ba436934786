from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators import gate, quality
from tidemark.sources import snapshots

SCHEMA = "id string, score double"
SUITE = [quality.not_null("id"), quality.unique("id"), quality.between("score", 1, 10, mostly=0.5)]
NOW = datetime(2024, 1, 1)


def test_only_passing_batches_are_published(spark, frame, tmp_path):
    path, log = f"{tmp_path}/table", f"{tmp_path}/log"
    batches = [
        [("a", 1.0), ("b", 11.0)],
        [("c", 2.0), (None, 3.0)],
        [("d", 2.0), ("d", 3.0)],
        [("e", 20.0), ("f", 30.0), ("g", 3.0)],
        [],
        [("a", None)],
    ]
    for i, rows in enumerate(batches):
        row = gate.append_checked(frame(rows, SCHEMA), path, SUITE, f"b{i}", "t", NOW)
        whole = quality.run_checkpoint(frame(rows, SCHEMA), SUITE, f"b{i}", "t", NOW)
        for column in ("status", "failed_count", "success_percent", "row_count", "run_time"):
            assert row.first()[column] == whole.first()[column], (i, column)
        quality.log_validation(row, log)
    statuses = {r.checkpoint_name: r.status for r in spark.read.parquet(log).collect()}
    assert [statuses[f"b{i}"] for i in range(6)] == ["passed", "failed", "failed", "failed", "passed", "passed"]
    got = sorted(tuple(r) for r in gate.read_checked(spark, path, SCHEMA).collect() if r.score)
    assert got == [("a", 1.0), ("b", 11.0)]
    assert gate.read_checked(spark, path, SCHEMA).count() == 3
    # What was not published is deleted after its grace.
    assert len(snapshots.drop_unlisted(spark, path, 1 << 60)) == 3
    assert gate.read_checked(spark, path, SCHEMA).count() == 3


def test_rows_are_computed_once(spark, frame, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return x

    df = frame([(str(i), float(i % 9 + 1)) for i in range(50)], SCHEMA).repartition(5)
    df = df.withColumn("score", counted("score"))
    row = gate.append_checked(df, f"{tmp_path}/table", SUITE, "b", "t", NOW)
    assert row.first().status == "passed" and seen.value == 50


def test_a_failing_job_gives_an_error_row(spark, frame, tmp_path):
    path = f"{tmp_path}/table"
    df = frame([("a", 1.0)], SCHEMA).withColumn("score", F.raise_error(F.lit("lost")).cast("double"))
    row = gate.append_checked(df, path, SUITE, "b", "t", NOW).first()
    assert row.status == "error" and "lost" in row.metadata
    assert gate.read_checked(spark, path, SCHEMA).count() == 0
