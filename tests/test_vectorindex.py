import numpy as np
import pytest
from pyspark.sql import functions as F
from test_vectors import brute

from tidemark.operators import vectorindex, vectors

RECORD = "namespace string, id string, values array<float>"
QUERY = "query_id string, values array<float>"


@pytest.fixture(scope="module")
def points():
    """Six narrow bundles of directions, one of them mostly copies, and gaps."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(6, 8))
    found = centres[rng.integers(0, 6, 600)] + rng.normal(size=(600, 8)) * 0.05
    found[200:400] = found[200]  # a third of all vectors are copies
    found[7] = 0  # no direction
    return found.astype("float32")


def _stored(spark, points):
    odd = [("short", [1.0]), ("none", None), ("gap", [1.0, None, *[0.0] * 6])]
    rows = odd + [(f"v{i:03d}", points[i].tolist()) for i in range(len(points))]
    named = [(vectors.NAMESPACE, *row) for row in rows] + [("other", "foreign", points[3].tolist())]
    return spark.createDataFrame(named, RECORD).repartition(5)


@pytest.fixture(scope="module")
def index(spark, points, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index")) + "/v"
    vectorindex.build_index(_stored(spark, points), path)
    return vectorindex.open_index(spark, path)


def _found(rows):
    got = {}
    for r in rows.orderBy("query_id", "position").collect():
        got.setdefault(r.query_id, []).append((r.id, r.score))
    return got


@pytest.mark.parametrize("k", [1, 10, 50])
def test_equals_brute_force(spark, points, index, k):
    asked = {f"q{i}": points[i * 30] for i in range(20)}
    asked |= {f"far{i}": -points[i * 50] for i in range(4)}
    queries = spark.createDataFrame([(q, v.tolist()) for q, v in asked.items()], QUERY).repartition(3)
    got = _found(vectorindex.search_index(index, queries, k))
    assert got == {q: brute(points, v, k) for q, v in asked.items()}


def test_equals_the_search_without_an_index(spark, points, index):
    rng = np.random.default_rng(2)
    rows = [(f"q{i}", rng.normal(size=8).tolist()) for i in range(40)]
    queries = spark.createDataFrame(rows, QUERY)
    stored = _stored(spark, points).filter("forall(values, x -> x IS NOT NULL)")
    plain = vectors.search_batch(stored, queries, 7)
    assert _found(vectorindex.search_index(index, queries, 7)) == _found(plain)


def test_far_clusters_stay_unread(spark, points, index):
    queries = spark.createDataFrame([("q", points[1].tolist())], QUERY)
    read = vectorindex.clusters_read(index, queries, 5).collect()
    assert len(read) == 1
    assert read[0].clusters < len(index.numbers) / 2 and read[0].vectors < 400
    plan = vectorindex.search_index(index, queries, 5)._jdf.queryExecution().toString()
    assert "PartitionFilters: [cluster" in plan


def test_every_vector_is_in_the_index_once(spark, index):
    blocks = spark.read.parquet(f"{index.path}/blocks")
    ids = blocks.select("cluster", F.explode("ids").alias("id"))
    assert ids.count() == ids.select("id").distinct().count() == 600
    assert [r.id for r in ids.filter("cluster = -1").collect()] == ["v007"]
    assert int(index.sizes.sum()) == 599


def test_small_blocks_give_the_same(spark, points, tmp_path, monkeypatch):
    monkeypatch.setattr(vectorindex, "BLOCK_QUERIES", 2)
    vectorindex.build_index(_stored(spark, points), f"{tmp_path}/v", clusters=3)
    index = vectorindex.open_index(spark, f"{tmp_path}/v")
    rows = [(f"q{i}", points[i * 40].tolist()) for i in range(9)]
    queries = spark.createDataFrame(rows, QUERY).coalesce(1)
    got = _found(vectorindex.search_index(index, queries, 12))
    assert got == {f"q{i}": brute(points, points[i * 40], 12) for i in range(9)}


def test_queries_that_cannot_match(spark, points, index):
    def search(rows):
        return vectorindex.search_index(index, spark.createDataFrame(rows, QUERY), 5).collect()

    assert search([]) == []
    assert search([("zero", [0.0] * 8), ("none", None)]) == []
    with pytest.raises(ValueError, match="unique"):
        search([("q", points[0].tolist()), ("q", points[1].tolist())])
    with pytest.raises(ValueError, match="length"):
        search([("q", [1.0])])
    with pytest.raises(ValueError):
        vectorindex.search_index(index, spark.createDataFrame([], QUERY), 51)


def test_empty_index(spark, tmp_path):
    vectorindex.build_index(spark.createDataFrame([], RECORD), f"{tmp_path}/v")
    index = vectorindex.open_index(spark, f"{tmp_path}/v")
    queries = spark.createDataFrame([("q", [1.0])], QUERY)
    assert vectorindex.search_index(index, queries, 5).collect() == []
