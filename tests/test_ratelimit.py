"""Anchored rate-limit windows against a walk over the sorted requests."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ratelimit
from tidemark.operators.ratelimit import rate_limit, rate_limit_step

SCHEMA = "key string, ts timestamp_ntz, id long"
START = datetime(2024, 1, 1)


def walk(rows, seconds):
    """Request numbers by id, one key after the other."""
    numbers = {}
    by_key = defaultdict(list)
    for key, ts, ident in rows:
        by_key[key].append((ts, ident))
    for requests in by_key.values():
        anchor, count = None, 0
        for ts, ident in sorted(requests):
            if anchor is None or ts >= anchor + timedelta(seconds=seconds):
                anchor, count = ts, 0
            count += 1
            numbers[ident] = count
    return numbers


def make(rng, counts, mean_gap):
    rows, ident = [], 0
    for key, count in counts.items():
        ts = START
        for _ in range(count):
            ts += timedelta(seconds=rng.expovariate(1 / mean_gap))
            rows.append((key, ts, ident))
            ident += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "name, counts, mean_gap, seconds, pieces",
    [
        ("one hot key over many pieces", {"hot": 3000, "b": 40, "c": 1}, 5, 60, 16),
        ("windows longer than a piece", {"hot": 2000, "b": 10}, 1, 500, 16),
        ("one window over everything", {"hot": 1500}, 0.1, 10_000, 8),
        ("pauses cut every window", {"hot": 1000, "b": 1000}, 100, 30, 12),
        ("many keys", {f"k{i}": 7 for i in range(200)}, 20, 60, 8),
    ],
)
def test_equals_a_walk(frame, name, counts, mean_gap, seconds, pieces):
    rows = make(random.Random(name), counts, mean_gap)
    flagged = rate_limit(
        frame(rows, SCHEMA), "key", "ts", 3, seconds, order=("id",), pieces=pieces
    ).collect()
    expected = walk(rows, seconds)
    assert len(flagged) == len(rows)
    for row in flagged:
        number = expected[row.id]
        assert (row.request_number, row.allowed, row.remaining) == (
            number, number <= 3, max(0, 3 - number)
        )


def test_same_moment_and_window_end(frame):
    ends = [START, START, START + timedelta(seconds=60), START + timedelta(seconds=59, microseconds=999999)]
    rows = [("a", ts, i) for i, ts in enumerate(ends)]
    flagged = rate_limit(frame(rows, SCHEMA), "key", "ts", 1, 60, order=("id",))
    got = {r.id: (r.request_number, r.allowed) for r in flagged.collect()}
    assert got == {0: (1, True), 1: (2, False), 2: (1, True), 3: (3, False)}


def test_requests_without_key_are_allowed(frame):
    rows = [(None, START, 0), (None, START, 1), ("a", START, 2)]
    flagged = rate_limit(frame(rows, SCHEMA), "key", "ts", 1, 60, order=("id",))
    assert {(r.id, r.allowed, r.remaining) for r in flagged.collect()} == {
        (0, True, 1), (1, True, 1), (2, True, 0)
    }


def test_never_more_than_the_limit_in_a_window(frame):
    rows = make(random.Random(7), {"x": 800, "y": 300}, 10)
    flagged = rate_limit(frame(rows, SCHEMA), "key", "ts", 2, 60, order=("id",), pieces=6)
    allowed = flagged.filter("allowed").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    times = defaultdict(list)
    for row in allowed.orderBy("ts").collect():
        times[row.key].append(row.ts)
    for moments in times.values():
        for first, third in zip(moments, moments[2:]):
            # Three allowed requests always touch two windows.
            assert third > first
        assert len(moments) <= 2 * (1 + (max(moments) - min(moments)).total_seconds() / 60)


def test_step_by_step_equals_a_walk(frame):
    rows = sorted(make(random.Random(3), {"hot": 900, "b": 100, "late": 5}, 4), key=lambda r: r[1])
    expected = walk(rows, 60)
    windows, numbers = None, {}
    for start in range(0, len(rows), 400):
        part = frame(rows[start : start + 400], SCHEMA)
        flagged, windows = rate_limit_step(part, windows, "key", "ts", 3, 60, ("id",), pieces=5)
        numbers |= {r.id: r.request_number for r in flagged.collect()}
        newest = max(r[1] for r in rows[start : start + 400])
        for window in windows.collect():
            assert window.counted > 0
            assert window.anchor_us + 60_000_000 > (newest - datetime(1970, 1, 1)).total_seconds() * 1e6
    assert numbers == expected


def test_late_requests_count_when_they_arrive(frame):
    def step(rows, windows):
        flagged, windows = rate_limit_step(
            frame([(k, START + timedelta(seconds=s), i) for k, s, i in rows], SCHEMA),
            windows, "key", "ts", 2, 60, ("id",), pieces=2,
        )
        got = {r.id: (r.ts, r.request_number, r.allowed) for r in flagged.collect()}
        return {i: got[i][1:] for _, s, i in rows if got[i][0] == START + timedelta(seconds=s)}, windows

    got, windows = step([("a", 20, 1), ("a", 21, 2), ("b", 21, 3)], None)
    assert got == {1: (1, True), 2: (2, True), 3: (1, True)}
    # In the open window; of a key without one; a repeat of the window's first moment.
    got, windows = step([("a", 10, 4), ("c", 10, 5), ("b", 21, 6)], windows)
    assert got == {4: (3, False), 5: (1, True), 6: (2, True)}
    assert {r.key: r.anchor_us // 10**6 % 60 for r in windows.collect()} == {"a": 20, "b": 21, "c": 21}
    # An empty part changes nothing; late requests part by part do not escape the limit.
    got, windows = step([], windows)
    assert got == {} and windows.count() == 3
    got, windows = step([("c", 5, 7)], windows)
    assert got == {7: (2, True)}
    got, windows = step([("c", 4, 8), ("a", 80, 9)], windows)
    assert got == {8: (3, False), 9: (1, True)}


WIDE = "key string, ts timestamp_ntz, id long, acct long"
BIG = 2**60


def wide_rows():
    """Ids and a column with nulls that a double cannot hold."""
    return [
        ("a", START + timedelta(seconds=i), BIG + 2 * i, None if i % 3 else BIG + 2 * i)
        for i in range(30)
    ]


def test_large_longs_come_back_unchanged(frame):
    rows = wide_rows()
    flagged = rate_limit(frame(rows, WIDE), "key", "ts", 3, 10, order=("id",), pieces=4)
    assert sorted((r.id, r.acct, r.request_number) for r in flagged.collect()) == [
        (ident, acct, i % 10 + 1) for i, (_, _, ident, acct) in enumerate(rows)
    ]


def test_large_longs_come_back_unchanged_step_by_step(frame):
    rows = wide_rows()
    windows, got = None, []
    for start in (0, 15):
        part = frame(rows[start : start + 15], WIDE)
        flagged, windows = rate_limit_step(part, windows, "key", "ts", 3, 10, ("id",), pieces=3)
        got += [(r.id, r.acct, r.request_number) for r in flagged.collect()]
    assert sorted(got) == [
        (ident, acct, i % 10 + 1) for i, (_, _, ident, acct) in enumerate(rows)
    ]


@pytest.mark.parametrize("mean_gap, seconds", [(5, 60), (1, 500), (0.1, 10_000)])
def test_hand_overs_through_many_levels(frame, monkeypatch, mean_gap, seconds):
    monkeypatch.setattr(ratelimit, "FAN_IN", 2)
    rows = make(random.Random(seconds), {"a": 30, "hot": 1500, "z": 200}, mean_gap)
    flagged = rate_limit(
        frame(rows, SCHEMA), "key", "ts", 3, seconds, order=("id",), pieces=20
    )
    assert {r.id: r.request_number for r in flagged.collect()} == walk(rows, seconds)


def test_pieces_are_counted_from_rows_and_jobs_grow_with_levels(spark, frame, monkeypatch):
    monkeypatch.setattr(ratelimit, "PIECE_ROWS", 40)
    context = spark.sparkContext
    jobs = {}
    for count in (640, 2560):  # 16 and 64 pieces
        rows = [("hot", START + timedelta(seconds=7 * i), i) for i in range(count)]
        context.setJobGroup(f"limit-{count}", "")
        flagged = rate_limit(frame(rows, SCHEMA), "key", "ts", 3, 60, order=("id",))
        got = {r.id: r.request_number for r in flagged.collect()}
        jobs[count] = len(context.statusTracker().getJobIdsForGroup(f"limit-{count}"))
        assert got == walk(rows, 60)
    context.setJobGroup("", "")
    # Two more levels' jobs for four times the pieces, not one job for each piece.
    assert jobs[2560] <= jobs[640] + 12
