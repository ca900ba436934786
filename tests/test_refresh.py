import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql.types import StructField, StructType

from tidemark.operators import gold, staging
from tidemark.sources import refresh, snapshots, tables
from tidemark.sources.schemas import BRONZE

START = datetime(2024, 3, 1)
SCHEMA = StructType([StructField(f.name, f.dataType) for f in BRONZE.fields])
AS_OF = "2024-04-01 00:00:00"


def message(rng, day, **changes):
    symbol = rng.choice(["btc", "BTC", "eth"])
    row = {
        "id": f"m{rng.randrange(10**9)}",
        "raw_payload": f'{{"symbol": "{symbol}", "price_usd": {rng.randrange(1, 99)}}}',
        "source": rng.choice("ab"),
        "ingested_at": START + timedelta(days=day, seconds=rng.randrange(86_400)),
        "sentiment_score": rng.choice([None, 2.0, 5.0, 9.0]),
    } | changes
    return tuple(row.get(f.name) for f in BRONZE.fields)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def whole(spark, bronze_path):
    """The table as a full refresh gives it."""
    bronze = tables.read_bronze(spark, bronze_path, AS_OF)
    return rows_of(gold.hourly_sentiment(staging.stage_market_data(bronze, AS_OF, None), AS_OF))


@pytest.fixture
def load(spark, frame, tmp_path):
    paths = f"{tmp_path}/bronze", f"{tmp_path}/gold"

    def append(rows):
        tables.write_bronze(frame(rows, SCHEMA), paths[0])
        return refresh.refresh_hourly(spark, *paths, AS_OF)

    append.paths = paths
    return append


def test_any_loads_equal_a_full_refresh(spark, load):
    rng = random.Random(2)
    for days in ([0, 1, 2], [2, 3], [0], [9]):
        rows = [message(rng, rng.choice(days)) for _ in range(25)]
        redone = load(rows + rows[:2])
        assert redone == sorted({f"{r[BRONZE.names.index('ingested_at')]:%Y-%m-%d}" for r in rows})
        assert rows_of(refresh.read_hourly(spark, load.paths[1])) == whole(spark, load.paths[0])
    assert refresh.refresh_hourly(spark, *load.paths, AS_OF) == []
    recent = refresh.read_hourly(spark, load.paths[1], "2024-03-04")
    assert {r.hour_timestamp.day for r in recent.collect()} <= {4, 10}


def test_untouched_folders_stay(spark, load):
    rng = random.Random(3)
    load([message(rng, day, sentiment_score=3.0) for day in range(4)])
    before = snapshots.current(spark, load.paths[1])
    assert load([message(rng, 2, sentiment_score=8.0)]) == ["2024-03-03"]
    after = snapshots.current(spark, load.paths[1])
    assert {d for d in after.parts if after.parts[d] != before.parts[d]} == {"2024-03-03"}
    # A reader that opened the table before still finds what it opened.
    assert refresh.read_hourly(spark, load.paths[1], snapshot=before).count() == 4
    assert len(snapshots.drop_unlisted(spark, load.paths[1], 1 << 60)) == 0
    assert rows_of(refresh.read_hourly(spark, load.paths[1])) == whole(spark, load.paths[0])


def test_only_folders_of_changed_dates_are_read(spark, load):
    rng = random.Random(4)
    load([message(rng, day) for day in range(4)])
    read = refresh._of_days(spark.read.parquet(load.paths[0]), "ingest_date", ["2024-03-02"])
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*ingest_date", plan) and read.count() == 1


def test_dates_without_time_score_or_files(spark, load, tmp_path):
    rng = random.Random(5)
    rows = [message(rng, 0, sentiment_score=4.0), message(rng, 1, sentiment_score=None)]
    rows.append(message(rng, 0, ingested_at=None, sentiment_score=6.0))
    assert load(rows) == ["2024-03-01", "2024-03-02", refresh.UNDATED]
    assert set(snapshots.current(spark, load.paths[1]).parts) == {"2024-03-01", refresh.UNDATED}
    assert rows_of(refresh.read_hourly(spark, load.paths[1])) == whole(spark, load.paths[0])
    assert refresh.read_hourly(spark, load.paths[1], "2024-01-01").count() == 1
    (tmp_path / "bronze" / "ingest_date=2024-03-01").rename(tmp_path / "gone")
    assert refresh.refresh_hourly(spark, *load.paths, AS_OF) == ["2024-03-01"]
    assert rows_of(refresh.read_hourly(spark, load.paths[1])) == whole(spark, load.paths[0])


def test_a_crash_before_the_swap_changes_nothing(spark, load, monkeypatch):
    rng = random.Random(6)
    load([message(rng, 0, sentiment_score=4.0)])
    before = rows_of(refresh.read_hourly(spark, load.paths[1]))

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "publish", crash)
        with pytest.raises(OSError):
            load([message(rng, 0, sentiment_score=9.0)])
    assert rows_of(refresh.read_hourly(spark, load.paths[1])) == before
    assert refresh.refresh_hourly(spark, *load.paths, AS_OF) == ["2024-03-01"]
    assert rows_of(refresh.read_hourly(spark, load.paths[1])) == whole(spark, load.paths[0])


def test_a_table_never_refreshed_is_told(spark, tmp_path):
    with pytest.raises(ValueError):
        refresh.read_hourly(spark, f"{tmp_path}/none")
