import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import enrich, vectors
from tidemark.sources.schemas import VECTOR_RECORD


def record(ident, values, symbol="BTC", category="BULLISH", timestamp="2024-01-01", namespace=vectors.NAMESPACE):
    return (namespace, ident, values, (symbol, "s", 5.0, category, 1.0, 1.0, "h", "r", timestamp))


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(5)
    points = rng.normal(size=(400, 8)).astype("float32")
    points[100:140] = points[100]  # a group of copies
    points[7] = 0  # no direction
    rows = [record(f"v{i:03d}", points[i].tolist()) for i in range(len(points))]
    return spark.createDataFrame(rows, VECTOR_RECORD).repartition(7), points


def brute(points, query, k):
    points, query = points.astype("float64"), np.asarray(query, dtype="float64")
    norms = np.linalg.norm(points, axis=1) * np.linalg.norm(query)
    scored = [
        (-round(float(p @ query) / n, 9), f"v{i:03d}")
        for i, (p, n) in enumerate(zip(points, norms))
        if n > 0
    ]
    return [(ident, round(-score, 4) + 0.0) for score, ident in sorted(scored)[:k]]


@pytest.mark.parametrize("index, k", [(0, 10), (100, 10), (100, 50), (3, 1)])
def test_search_equals_brute_force(cloud, index, k):
    df, points = cloud
    found = vectors.semantic_search(df, points[index].tolist(), k).collect()
    assert [(r.id, r.score) for r in found] == brute(points, points[index], k)


def test_batch_equals_brute_force_in_any_number_of_passes(spark, cloud):
    df, points = cloud
    queries = spark.createDataFrame(
        [(f"q{i}", points[i * 10].tolist()) for i in range(12)], "query_id string, values array<float>"
    )
    for per_pass in (100, 3):
        rows = vectors.search_batch(df, queries, 5, per_pass).orderBy("query_id", "position").collect()
        for i in range(12):
            mine = [(r.id, r.score) for r in rows if r.query_id == f"q{i}"]
            assert mine == brute(points, points[i * 10], 5)


def test_repeated_query_ids_are_refused(spark, cloud):
    df, points = cloud
    rows = [("same", points[i].tolist()) for i in range(5)]
    queries = spark.createDataFrame(rows, "query_id string, values array<float>")
    with pytest.raises(ValueError, match="unique"):
        vectors.search_batch(df, queries, 5, 2)


def test_queries_without_direction_or_vector_find_nothing(spark, cloud):
    df, _ = cloud
    queries = spark.createDataFrame(
        [("zero", [0.0] * 8), ("none", None)], "query_id string, values array<float>"
    )
    assert vectors.search_batch(df, queries, 5).collect() == []
    nobody = queries.filter("query_id = 'nobody'")
    assert vectors.search_batch(df, nobody, 5).collect() == []


def test_similar_leaves_itself_out(cloud):
    df, points = cloud
    found = vectors.find_similar(df, "v005", 5).collect()
    others = [pair for pair in brute(points, points[5], 6) if pair[0] != "v005"]
    assert [(r.id, r.similarity_score) for r in found] == others[:5]
    assert vectors.find_similar(df, "unknown").collect() == []


def test_metadata_filters_come_before_and_the_minimum_after(frame):
    rows = [record(f"a{i}", [1.0, i / 10], symbol="ETH") for i in range(5)]
    rows += [record(f"b{i}", [1.0, 0.0]) for i in range(5)]
    rows += [record("c", [1.0, 0.0], namespace="elsewhere")]
    df = frame(rows, VECTOR_RECORD)
    ids = [r.id for r in vectors.semantic_search(df, [1.0, 0.0], 3, symbol="eth").collect()]
    assert ids == ["a0", "a1", "a2"]
    kept = vectors.semantic_search(df, [1.0, 0.0], 3, symbol="ETH", min_score=0.99)
    assert [r.id for r in kept.collect()] == ["a0", "a1"]
    assert vectors.semantic_search(df, [1.0, 0.0], 3, symbol="ETH", min_score=0).count() == 3
    assert vectors.semantic_search(df, [1.0, 0.0], 3, sentiment="bearish").count() == 0
    with pytest.raises(ValueError):
        vectors.semantic_search(df, [1.0, 0.0], 51)


def test_missing_metadata_has_defaults(frame):
    df = frame([(vectors.NAMESPACE, "x", [1.0], None)], VECTOR_RECORD)
    row = vectors.semantic_search(df, [1.0]).first()
    assert (row.symbol, row.sentiment_score, row.sentiment_category, row.timestamp) == (
        "UNKNOWN", 5.0, "NEUTRAL", ""
    )


def test_upsert_keeps_the_last_write(frame):
    stored = frame([record("a", [1.0], timestamp="2024-05-01"), record("b", [1.0])], VECTOR_RECORD)
    updates = frame(
        [
            record("a", [2.0], timestamp="2024-02-01"),
            record("a", [3.0], timestamp="2024-03-01"),
            record("c", [4.0]),
            record("a", [5.0], namespace="other"),
        ],
        VECTOR_RECORD,
    )
    once = vectors.upsert_vectors(stored, updates)
    got = {(r.namespace, r.id): r["values"] for r in once.collect()}
    assert got == {
        (vectors.NAMESPACE, "a"): [3.0],
        (vectors.NAMESPACE, "b"): [1.0],
        (vectors.NAMESPACE, "c"): [4.0],
        ("other", "a"): [5.0],
    }
    again = {(r.namespace, r.id): r["values"] for r in vectors.upsert_vectors(once, updates).collect()}
    assert again == got


def test_embedder_reads_whole_texts(frame):
    tail = " ".join(["filler"] * 5000)
    df = frame([(1, f"{tail} bitcoin"), (2, f"{tail} ether"), (3, "  "), (4, None)], "i int, t string")
    rows = {r.i: r.v for r in enrich.hashing_embedding(df, "t", "v").collect()}
    assert rows[1] != rows[2] and rows[3] is None and rows[4] is None


def test_external_embedder_never_blocks_a_row(frame):
    def make_client():
        def embed(texts):
            if any("boom" in t for t in texts):
                raise RuntimeError("down")
            return [[float(len(t))] for t in texts]

        return embed

    df = frame([("abc",), ("boom",), (None,)], "t string")
    rows = enrich.embed_with_model(df, "t", "v", make_client, batch=1).collect()
    assert [r.v for r in rows] == [[3.0], None, None]


def test_external_scorer(frame):
    def make_client():
        def reply(prompts):
            return [
                RuntimeError("quota") if "bad" in p else '{"score": 12, "reasoning": "up"}' for p in prompts
            ]

        return reply

    df = frame([("good",), ("bad",)], "payload string")
    rows = enrich.score_with_model(df, F.col("payload"), make_client).collect()
    assert [(r.score, r.reasoning) for r in rows] == [(10.0, "up"), (None, "Analysis error: quota")]
