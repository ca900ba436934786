from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import quantiles

SCHEMA = "name string, attributes map<string,string>, value double, ts timestamp"
SHARES = [0.0, 0.1, 0.5, 0.9, 1.0]
START = datetime(2024, 1, 1)


def _events(frame):
    """Three days of two histograms: a skewed one and one with few values, and gaps."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(6000):
        ts = START + timedelta(minutes=int(rng.integers(0, 3 * 1440)))
        rows.append(("request_latency", {"zone": str(i % 2)}, float(rng.lognormal()), ts))
        rows.append(("processing_latency", None, float(rng.integers(0, 4)), ts))
    rows += [
        ("request_latency", {"zone": "0"}, None, START),
        ("request_latency", {"zone": "0"}, float("nan"), START),
        ("errors", None, 1.0, START),
        ("unheard_of", None, 1.0, START),
        ("processing_latency", None, 2.0, None),
    ]
    return frame(rows, SCHEMA).repartition(6), rows


def test_days_merged_from_hours_keep_the_stated_error(frame, tmp_path, spark):
    events, rows = _events(frame)
    quantiles.hourly_sketches(events).write.parquet(f"{tmp_path}/hours")
    stored = spark.read.parquet(f"{tmp_path}/hours")
    # The hours are all that is read for a day.
    found = quantiles.quantiles(quantiles.merged(stored), SHARES).collect()
    assert len(found) == len({(r.day, r.name, r.attributes) for r in found}) * len(SHARES)
    for r in found:
        same = sorted(
            v
            for name, attributes, v, ts in rows
            if name == r.name and v is not None and v == v
            and (ts and ts.replace(hour=0, minute=0)) == r.day
            and (attributes or {}).get("zone", "") == (r.attributes.split('"')[3] if ":" in r.attributes else "")
        )
        assert r.n == len(same)
        low = sum(v < r.quantile for v in same) / len(same)
        high = sum(v <= r.quantile for v in same) / len(same)
        error = max(0.0, low - r.share, r.share - high)
        assert error <= 2 * quantiles.rank_error(quantiles.K)
        if r.share in (0.0, 1.0):
            assert r.quantile == (same[0] if r.share == 0 else same[-1])


def test_the_error_told_is_the_true_one(frame):
    rows = [("request_latency", None, float(i), START) for i in range(1, 101)]
    events = frame(rows, SCHEMA)
    found = frame(
        [(START, "request_latency", "{}", 100, share, q) for share, q in [(0.5, 50.0), (0.5, 70.0), (0.9, 80.0)]],
        "day timestamp, name string, attributes string, n long, share double, quantile double",
    )
    for share, quantile, error in [(0.5, 70.0, 0.19), (0.9, 80.0, 0.1), (0.5, 50.0, 0.0)]:
        one = found.filter((F.col("share") == share) & (F.col("quantile") == quantile))
        assert quantiles.observed_error(events, one).first().error == pytest.approx(error)


def test_larger_sketches_are_more_exact():
    assert quantiles.rank_error(200) == pytest.approx(0.0193, abs=0.0005)
    assert quantiles.rank_error(800) < quantiles.rank_error(400) < 0.0105


def test_no_events_no_sketches(frame):
    stored = quantiles.hourly_sketches(frame([], SCHEMA))
    assert quantiles.quantiles(quantiles.merged(stored), SHARES).count() == 0
