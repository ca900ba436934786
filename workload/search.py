"""Vector queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import enrich, vectorindex, vectors, vectorstore
from tidemark.plans.storage import scratch_path
from workload import sql
from workload.adapters import label_centroids, table, vector_records


def _records(spark, sf_dir):
    return vector_records(table(spark, sf_dir, "embeddings"))


def _query_vector(spark, sf_dir):
    """The stored vector of record 7, as the vector of a search text."""
    found = _records(spark, sf_dir).filter(F.col("id") == "7")
    return found.select("values").first()[0]


def semantic_search(spark, sf_dir):
    return vectors.semantic_search(
        _records(spark, sf_dir), _query_vector(spark, sf_dir), 50
    )


def semantic_search_filtered(spark, sf_dir):
    return vectors.semantic_search(
        _records(spark, sf_dir),
        _query_vector(spark, sf_dir),
        symbol="Sym7",
        sentiment="bullish",
    )


def semantic_search_min_score(spark, sf_dir):
    return vectors.semantic_search(
        _records(spark, sf_dir), _query_vector(spark, sf_dir), 50, min_score=0.1
    )


def find_similar(spark, sf_dir):
    return vectors.find_similar(_records(spark, sf_dir), "7", 20)


def search_batch(spark, sf_dir):
    """The records nearest to the mean vector of every label."""
    queries = label_centroids(table(spark, sf_dir, "embeddings"))
    return vectors.search_batch(_records(spark, sf_dir), queries, 20)


def search_index(spark, sf_dir):
    """The same search through an index that leaves clusters unread."""
    embeddings = table(spark, sf_dir, "embeddings")
    path = scratch_path(spark, "vector-index")
    vectorindex.build_index(vector_records(embeddings), path)
    index = vectorindex.open_index(spark, path)
    return vectorindex.search_index(index, label_centroids(embeddings), 20)


def _rewritten(stored, moment: str, symbol: str):
    """Labels above 4 once more, with another time and symbol."""
    changed = F.col("metadata").withField("timestamp", F.lit(moment))
    return stored.filter(F.col("metadata.sentiment_score") > 5).withColumn(
        "metadata", changed.withField("symbol", F.lit(symbol))
    )


def _upserted(records):
    return records.select(
        "namespace",
        "id",
        F.col("metadata.symbol").alias("symbol"),
        F.col("metadata.timestamp").alias("timestamp"),
        F.size("values").alias("dims"),
        F.col("values")[0].cast("double").alias("first_value"),
    )


def upsert_vectors(spark, sf_dir):
    """Labels above 4 written again twice; the later write must win."""
    stored = _records(spark, sf_dir)
    updates = _rewritten(stored, "2024-03-01T00:00:00", "LAST").unionByName(
        _rewritten(stored, "2024-02-01T00:00:00", "FIRST")
    )
    return _upserted(vectors.upsert_vectors(stored, updates))


def vector_store(spark, sf_dir):
    """The same writes, one after the other, into a store of buckets."""
    stored, path = _records(spark, sf_dir), scratch_path(spark, "vector-store")
    vectorstore.write_updates(stored, path)
    vectorstore.write_updates(_rewritten(stored, "2024-02-01T00:00:00", "FIRST"), path)
    vectorstore.write_updates(_rewritten(stored, "2024-03-01T00:00:00", "LAST"), path)
    return _upserted(vectorstore.read_store(spark, path))


def vector_metadata(spark, sf_dir):
    return _records(spark, sf_dir).select("id", "metadata.*")


def embed_documents(spark, sf_dir):
    """Words and vector length of every document under the default embedder."""
    documents = table(spark, sf_dir, "documents")
    counted = enrich.word_counts(documents, "text")
    embedded = enrich.hashing_embedding(counted, "text", "values")
    squares = F.aggregate(
        "values", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
    )
    return embedded.select("doc_id", "words", F.round(squares, 4).alias("squared_length"))


def text_search(spark, sf_dir):
    """The documents nearest to every benchmark text, both embedded whole."""
    documents = table(spark, sf_dir, "documents")
    asked = table(spark, sf_dir, "benchmark")
    stored = enrich.hashing_embedding(documents, "text", "values").select(
        F.lit(vectors.NAMESPACE).alias("namespace"),
        F.col("doc_id").cast("string").alias("id"),
        "values",
    )
    queries = enrich.hashing_embedding(asked, "text", "values").select(
        F.col("item_id").alias("query_id"), "values"
    )
    return vectors.search_batch(stored, queries, 5)


QUERIES = {
    f.__name__: f
    for f in (
        semantic_search,
        semantic_search_filtered,
        semantic_search_min_score,
        find_similar,
        search_batch,
        search_index,
        upsert_vectors,
        vector_store,
        vector_metadata,
        embed_documents,
        text_search,
    )
}

_RECORDS = """
records AS (
  SELECT CAST(vec_id AS VARCHAR) AS id, label, CAST(embedding AS DOUBLE[]) AS v,
         CASE WHEN label <> 0 THEN 'SYM' || label END AS symbol,
         CASE WHEN label <> 0 THEN CAST(1 + label AS DOUBLE) END AS sentiment_score,
         CASE WHEN label = 0 THEN NULL WHEN 1 + label >= 7 THEN 'BULLISH'
              WHEN 1 + label < 4 THEN 'BEARISH' ELSE 'NEUTRAL' END AS sentiment_category,
         CASE WHEN label <> 0 THEN CAST(0 AS DOUBLE) END AS price_usd,
         CASE WHEN label <> 0 THEN CAST(label - 5 AS DOUBLE) END AS percent_change_24h,
         CASE WHEN label <> 0 THEN 'headline ' || label END AS news_headline,
         CASE WHEN label <> 0 THEN '' END AS reasoning,
         CASE WHEN label <> 0 THEN '2024-01-01T00:00:00' END AS timestamp
  FROM embeddings
)"""

_SCORED = _RECORDS + """,
scored AS (
  SELECT r.*, CAST(list_cosine_similarity(r.v, q.v) AS DECIMAL(38,9)) AS s
  FROM records r, (SELECT v FROM records WHERE id = '7') q
)"""

_MATCH = """
SELECT id, CAST(round(s, 4) AS DOUBLE) AS score, coalesce(symbol, 'UNKNOWN') AS symbol,
       coalesce(sentiment_score, 5) AS sentiment_score,
       coalesce(sentiment_category, 'NEUTRAL') AS sentiment_category,
       price_usd, percent_change_24h, news_headline, reasoning,
       coalesce(timestamp, '') AS timestamp"""

ORACLE = {
    "semantic_search": f"WITH {_SCORED} {_MATCH} FROM scored ORDER BY s DESC, id LIMIT 50",
    "semantic_search_filtered": f"""WITH {_SCORED} {_MATCH} FROM scored
WHERE symbol = 'SYM7' AND sentiment_category = 'BULLISH' ORDER BY s DESC, id LIMIT 10""",
    "semantic_search_min_score": f"""WITH {_SCORED},
best AS (SELECT * FROM scored ORDER BY s DESC, id LIMIT 50)
{_MATCH} FROM best WHERE s >= 0.1""",
    "find_similar": f"""WITH {_SCORED}
SELECT id, CAST(round(s, 4) AS DOUBLE) AS similarity_score, coalesce(symbol, 'UNKNOWN') AS symbol,
       coalesce(sentiment_score, 5) AS sentiment_score,
       coalesce(sentiment_category, 'NEUTRAL') AS sentiment_category,
       news_headline, coalesce(timestamp, '') AS timestamp
FROM scored WHERE id <> '7' ORDER BY s DESC, id LIMIT 20""",
    "search_batch": f"""WITH {_RECORDS},
means AS (
  SELECT label, pos, avg(x) AS mean
  FROM (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM records)
  GROUP BY label, pos
),
queries AS (SELECT label, list(mean ORDER BY pos) AS q FROM means GROUP BY label),
scored AS (
  SELECT CAST(queries.label AS VARCHAR) AS query_id, id,
         CAST(list_cosine_similarity(v, q) AS DECIMAL(38,9)) AS s
  FROM records, queries
)
SELECT query_id, CAST(position AS INTEGER) AS position, id, CAST(round(s, 4) AS DOUBLE) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS position FROM scored)
WHERE position <= 20""",
    "upsert_vectors": f"""WITH {_RECORDS}
SELECT 'market-data' AS namespace, id,
       CASE WHEN sentiment_score > 5 THEN 'LAST' ELSE symbol END AS symbol,
       CASE WHEN sentiment_score > 5 THEN '2024-03-01T00:00:00' ELSE timestamp END AS timestamp,
       CAST(len(v) AS INTEGER) AS dims, v[1] AS first_value
FROM records""",
    "vector_metadata": f"""WITH {_RECORDS}
SELECT id, symbol, CASE WHEN label <> 0 THEN 'unknown' END AS source, sentiment_score,
       sentiment_category, price_usd, percent_change_24h, news_headline, reasoning, timestamp
FROM records""",
    "embed_documents": """
SELECT doc_id, CAST(len(list_filter(string_split_regex(lower(text), '\\s+'), lambda x: x <> '')) AS INTEGER) AS words,
       CAST(1 AS DOUBLE) AS squared_length
FROM documents""",
}

ORACLE["search_index"] = ORACLE["search_batch"]
ORACLE["vector_store"] = ORACLE["upsert_vectors"]
