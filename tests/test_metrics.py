from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.operators import metrics
from tidemark.plans.pieces import running_sum
from tidemark.plans.skew import salted_join

EVENTS = "name string, attributes map<string,string>, value double"


def test_counters_by_equal_attributes(frame):
    rows = [
        ("request_count", {"a": "1", "b": "2"}, 1.0),
        ("request_count", {"b": "2", "a": "1"}, 2.0),
        ("request_count", None, 0.1),
        ("request_count", {}, 0.2),
        ("unknown", {}, 5.0),
        ("request_latency", {}, 5.0),
    ]
    rolled = {r.attributes: (r.total, r.events) for r in metrics.counter_rollup(frame(rows, EVENTS)).collect()}
    assert rolled == {'{"a":"1","b":"2"}': (3.0, 2), "{}": (0.3, 2)}
    assert metrics.ignored_metrics(frame(rows, EVENTS)).collect() == [("unknown", 1)]


def test_histogram_buckets(frame):
    rows = [("request_latency", None, v) for v in (1.0, 10.0, 10.5, 99.0, None)]
    row = metrics.histogram_rollup(frame(rows, EVENTS), [100, 10]).first()
    assert (row["count"], row["sum"], row["min"], row["max"]) == (4, 120.5, 1.0, 99.0)
    assert row.buckets == [2, 2, 0]


def test_running_level_over_pieces(frame):
    start = datetime(2024, 1, 1)
    rows = [("active_connections", start + timedelta(seconds=i), i, 1 if i % 3 else -1) for i in range(500)]
    df = frame(rows, "name string, ts timestamp_ntz, id int, value long")
    levels = metrics.running_level(df, ["ts", "id"]).orderBy("id").collect()
    total = 0
    for row in levels:
        total += row.value
        assert row.level == total
    assert len(levels) == 500


def test_running_sum_of_hot_and_small_keys(frame):
    rows = [("hot", i, i) for i in range(300)] + [(f"k{i % 7}", i, 1) for i in range(70)]
    summed = running_sum(frame(rows, "k string, i int, v long"), "v", ["i"], ["k"], pieces=9)
    expected, totals = {}, {}
    for k, i, v in sorted(rows):
        totals[k] = totals.get(k, 0) + v
        expected[k, i] = totals[k]
    assert {(r.k, r.i): r.running for r in summed.collect()} == expected


def test_salted_join_equals_a_join(frame):
    big = frame([("hot", i) for i in range(200)] + [("cold", 900), (None, 901)], "k string, i int")
    small = frame([("hot", "x"), ("other", "y")], "k string, v string")
    plain = {tuple(r) for r in big.join(small, "k", "left").select("k", "i", "v").collect()}
    salted = salted_join(big, small, "k", ["i"], "left").select("k", "i", "v").collect()
    assert len(salted) == 202 and {tuple(r) for r in salted} == plain


def test_latency(frame):
    start = datetime(2024, 1, 1)
    df = frame([(start, start + timedelta(microseconds=1500))], "start_ts timestamp_ntz, end_ts timestamp_ntz")
    assert metrics.latency_ms(df).first().latency_ms == 1.5


def test_errors(frame):
    rows = [("T", "s", "o"), ("T", "s", "o"), ("U", "s", "o")]
    rolled = metrics.error_rollup(frame(rows, "error_type string, service string, operation string"))
    assert {tuple(r) for r in rolled.collect()} == {("T", "s", "o", 2), ("U", "s", "o", 1)}


def test_unused_attribute_order_in_json(frame):
    df = frame([({"z": "1", "a": None},)], "m map<string,string>")
    assert df.select(metrics.attributes_key(F.col("m"))).first()[0].startswith('{"a"')


def test_running_sum_keeps_null_keys_and_skips_null_values(frame):
    from tidemark.plans.pieces import running_sum

    rows = [("a", 1, None), ("a", 2, 5), (None, 1, 7), (None, 2, None), (None, 3, 1)]
    df = frame(rows, "k string, t long, v long")
    got = {(r.k, r.t): r.running for r in running_sum(df, "v", ["t"], by=["k"]).collect()}
    assert got == {("a", 1): 0, ("a", 2): 5, (None, 1): 7, (None, 2): 7, (None, 3): 8}
