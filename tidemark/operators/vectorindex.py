"""A vector index that leaves clusters unread and still finds the exact neighbours.

Vectors lie in clusters around centroids. Of each cluster the widest angle between
a member and the centroid is known, so the best cosine any member can have with a
query is known too. A query first reads the clusters nearest to it; after that
only those that could hold something as good as its k-th best match.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import snap_round
from tidemark.functions.times import column_type
from tidemark.operators.serving import check_bounds
from tidemark.operators.vectors import NAMESPACE, SCORE_DIGITS, SEARCH_TOP_K
from tidemark.plans.skew import salted_join
from tidemark.plans.storage import settle

#: Most clusters of an index; their centroids are read by every task.
MAX_CLUSTERS = 1024
#: Bounds of the sample that centroids are fitted on: vectors, and numbers in them.
SAMPLE_ROWS, SAMPLE_NUMBERS = 20_000, 4_000_000
FIT_ROUNDS = 8
SEED = 17
#: Vectors of one cluster that are compared at a time, and queries likewise.
BLOCK_ROWS, BLOCK_QUERIES = 4096, 512
#: Cluster of the vectors no query can match: without direction, or of another length.
UNMATCHED = -1
#: Scores are compared by 9 digits; a cluster this close below the k-th best is read.
DIGITS, SLACK = 9, 1e-6


@dataclass
class VectorIndex:
    """An index as stored: where it is, vector length, and its clusters' figures."""

    spark: SparkSession
    path: str
    dims: int
    dtype: str
    numbers: np.ndarray
    centroids: np.ndarray
    sizes: np.ndarray
    widest: np.ndarray


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; those without a direction become NaN."""
    with np.errstate(invalid="ignore", divide="ignore"):
        return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _directed(rows: np.ndarray) -> np.ndarray:
    """Which rows have a direction."""
    return np.isfinite(_unit(rows)).all(axis=1)


def _fit(sample: np.ndarray, clusters: int) -> np.ndarray:
    """Unit centroids of a sample, by spherical k-means from random members."""
    rng = np.random.default_rng(SEED)
    unit = _unit(sample)
    centres = unit[rng.choice(len(unit), min(clusters, len(unit)), replace=False)]
    for _ in range(FIT_ROUNDS):
        own = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, unit)
        lengths = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(lengths > 0, sums / np.where(lengths > 0, lengths, 1), centres)
    return centres


def _sample(vectors: DataFrame, rows: int, dims: int) -> np.ndarray:
    """At most a bounded number of directed vectors, drawn at random."""
    bound = max(1, min(SAMPLE_ROWS, SAMPLE_NUMBERS // dims))
    drawn = vectors.sample(min(1.0, 2 * bound / rows), SEED) if rows > bound else vectors
    found = drawn.select(F.col("values").cast("array<double>").alias("v")).limit(bound).toArrow()
    flat = found.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    sample = flat.reshape(-1, dims)
    return sample[_directed(sample)]


def build_index(vectors: DataFrame, path: str, clusters: int | None = None) -> None:
    """Write an index over ``vectors`` (namespace, id, values) under ``path``.

    Centroids come from a bounded sample, which decides how well the index prunes
    but never what it finds: every record of the namespace is assigned. There are
    about as many clusters as the root of the number of records, at most
    ``MAX_CLUSTERS``. Records of the most frequent vector length can be searched;
    null vectors, those with null entries and those of another length are kept aside.
    """
    spark = vectors.sparkSession
    whole = F.col("values").isNotNull() & F.forall("values", lambda x: x.isNotNull())
    stored = vectors.filter(F.col("namespace") == NAMESPACE)
    known = stored.filter(whole & (F.size("values") > 0))
    lengths = known.groupBy(F.size("values").alias("dims")).count()
    found = lengths.orderBy(F.desc("count"), F.desc("dims")).first()
    dims, rows = (found["dims"], found["count"]) if found else (0, 0)
    same = known.filter(F.size("values") == dims)
    centres = np.zeros((0, dims))
    if rows:
        wanted = clusters or min(MAX_CLUSTERS, max(1, math.isqrt(rows)))
        centres = _fit(_sample(same, rows, dims), wanted)
    kind = np.dtype("float32" if column_type(vectors, "values") == "array<float>" else "float64")
    shared = spark.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("values").flatten().to_numpy(zero_copy_only=False)
            matrix = flat.astype("float64").reshape(-1, dims)
            cluster = np.full(len(matrix), UNMATCHED)
            angle = np.zeros(len(matrix))
            fine = _directed(matrix)
            if fine.any() and len(shared.value):
                cosines = _unit(matrix[fine]) @ shared.value.T
                cluster[fine] = cosines.argmax(axis=1)
                angle[fine] = np.arccos(np.clip(cosines.max(axis=1), -1, 1))
            blobs = [row.tobytes() for row in matrix.astype(kind)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(cluster, pa.int32()),
                    pa.array(angle, pa.float64()),
                    pa.array(blobs, pa.binary()),
                ],
                names=["id", "cluster", "angle", "vector"],
            )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column("cluster").to_numpy()
            starts = np.flatnonzero(np.diff(numbers, prepend=np.iinfo("int32").min))
            for start, stop in zip(starts, [*starts[1:], len(numbers)]):
                for at in range(start, stop, BLOCK_ROWS):
                    part = batch.slice(at, min(BLOCK_ROWS, stop - at))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([numbers[at]], pa.int32()),
                            pa.array([part.column("angle").to_numpy().max()], pa.float64()),
                            pa.ListArray.from_arrays([0, len(part)], part.column("id")),
                            pa.array([b"".join(part.column("vector").to_pylist())], pa.binary()),
                        ],
                        names=["cluster", "widest", "ids", "vectors"],
                    )

    if rows:
        assigned = same.select(F.col("id").cast("string").alias("id"), "values").mapInArrow(
            assign, "id string, cluster int, angle double, vector binary"
        )
    else:
        assigned = spark.createDataFrame([], "id string, cluster int, angle double, vector binary")
    # A range of cluster and hash cuts a cluster with many members into several tasks.
    spread = F.xxhash64("id")
    blocks = (
        settle(assigned, "assigned")
        .withColumn("_spread", spread)
        .repartitionByRange("cluster", "_spread")
        .sortWithinPartitions("cluster")
        .drop("_spread")
        .mapInArrow(pack, "cluster int, widest double, ids array<string>, vectors binary")
    )
    blocks.write.partitionBy("cluster").parquet(f"{path}/blocks")
    figures = (
        spark.read.schema("widest double, ids array<string>, vectors binary, cluster int")
        .parquet(f"{path}/blocks")
        .groupBy("cluster")
        .agg(F.sum(F.size("ids")).alias("rows"), F.max("widest").alias("widest"))
        .filter(F.col("cluster") != UNMATCHED)
    )
    listed = [(i, centre.tolist(), dims, kind.name) for i, centre in enumerate(centres)]
    frame = spark.createDataFrame(listed, "cluster int, centroid array<double>, dims int, dtype string")
    frame.join(figures, "cluster").coalesce(1).write.parquet(f"{path}/clusters")


def open_index(spark: SparkSession, path: str) -> VectorIndex:
    """An index written by ``build_index``; at most ``MAX_CLUSTERS`` rows are read here."""
    rows = spark.read.parquet(f"{path}/clusters").orderBy("cluster").collect()
    dims = rows[0]["dims"] if rows else 0
    return VectorIndex(
        spark,
        path,
        dims,
        rows[0]["dtype"] if rows else "float64",
        np.array([row["cluster"] for row in rows], "int32"),
        np.array([row["centroid"] for row in rows]).reshape(len(rows), dims),
        np.array([row["rows"] for row in rows], "int64"),
        np.array([row["widest"] for row in rows]),
    )


def _bounds(index: VectorIndex):
    """A function from unit queries to their angle to every centroid and the best
    cosine that a member of its cluster can have; for use in the tasks."""
    figures = (index.centroids, index.widest)
    shared = index.spark.sparkContext.broadcast(figures)

    def bounds(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        centroids, widest = shared.value
        angles = np.arccos(np.clip(unit @ centroids.T, -1, 1))
        return angles, np.cos(np.maximum(angles - widest, 0))

    return bounds


def _asked(index: VectorIndex, queries: DataFrame, top_k: int) -> DataFrame:
    """Queries that can match, written out, with the clusters to read first: those of
    the best bounds until they hold ``top_k`` vectors."""
    known = queries.select(
        F.col("query_id").cast("string"), F.col("values").cast("array<double>").alias("values")
    ).filter(F.col("values").isNotNull())
    odd = F.count(F.when(F.size("values") != index.dims, 1))
    counted = known.agg(F.count("*"), F.count_distinct("query_id"), odd).first()
    if counted[0] != counted[1]:
        raise ValueError("query ids must be unique and not null")
    if counted[2]:
        raise ValueError(f"this index holds vectors of length {index.dims}")
    bounds, numbers, sizes = _bounds(index), index.numbers, index.sizes

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_QUERIES):
                batch = whole.slice(at, BLOCK_QUERIES)
                flat = batch.column("values").flatten().to_numpy(zero_copy_only=False)
                unit = _unit(flat.reshape(batch.num_rows, -1))
                fine = np.isfinite(unit).all(axis=1)
                angles, best = bounds(unit[fine])
                order = np.lexsort((angles, -best))
                held = np.cumsum(sizes[order], axis=1) - sizes[order]
                first = [numbers[row[:count]] for row, count in zip(order, (held < top_k).sum(axis=1))]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("query_id").filter(pa.array(fine)),
                        pa.array(list(unit[fine]), pa.list_(pa.float64())),
                        pa.array(first, pa.list_(pa.int32())),
                    ],
                    names=["query_id", "unit", "first"],
                )

    schema = "query_id string, unit array<double>, first array<int>"
    return settle(known.mapInArrow(choose, schema), "asked")


def _probes(index: VectorIndex, asked: DataFrame) -> DataFrame:
    """Clusters to read with the queries that ask for them, in blocks of queries.

    Without a ``floor`` these are the first clusters of every query; with it, all
    others whose best cosine may reach it.
    """
    bounds, numbers = _bounds(index), index.numbers
    later = "floor" in asked.columns

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_QUERIES):
                batch = whole.slice(at, BLOCK_QUERIES)
                unit = batch.column("unit").flatten().to_numpy().reshape(batch.num_rows, -1)
                names = np.array(batch.column("query_id").to_pylist(), dtype=object)
                first = [np.isin(numbers, own.values.to_numpy()) for own in batch.column("first")]
                chosen, floors = np.array(first), np.full(len(names), -2.0)
                if later:
                    floors = batch.column("floor").to_numpy(zero_copy_only=False)
                    chosen = ~chosen & (bounds(unit)[1] >= floors[:, None] - SLACK)
                for c in np.flatnonzero(chosen.any(axis=0)):
                    own = chosen[:, c]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "cluster": pa.array([numbers[c]], pa.int32()),
                            "query_ids": pa.array([names[own].tolist()], pa.list_(pa.string())),
                            "floors": pa.array([floors[own]], pa.list_(pa.float64())),
                            "units": pa.array([unit[own].tobytes()], pa.binary()),
                        }
                    )

    schema = "cluster int, query_ids array<string>, floors array<double>, units binary"
    return settle(asked.mapInArrow(choose, schema), "probes")


def _compare(index: VectorIndex, probes: DataFrame, top_k: int) -> DataFrame:
    """(query_id, id, score): the best ``top_k`` of every block a query reads."""
    wanted = [row["cluster"] for row in probes.select("cluster").distinct().collect()]
    blocks = index.spark.read.schema(
        "widest double, ids array<string>, vectors binary, cluster int"
    ).parquet(f"{index.path}/blocks")
    # A list of clusters, so that folders of others are not even listed for reading.
    read = blocks.filter(F.col("cluster").isin(wanted)).select("cluster", "ids", "vectors")
    dims, dtype = index.dims, index.dtype

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids = np.array(batch.column("ids")[row].values.to_pylist(), dtype=object)
                vectors = np.frombuffer(batch.column("vectors")[row].as_buffer(), dtype)
                vectors = vectors.astype("float64").reshape(-1, dims)
                units = np.frombuffer(batch.column("units")[row].as_buffer()).reshape(-1, dims)
                names = batch.column("query_ids")[row].values.to_pylist()
                floors = batch.column("floors")[row].values.to_numpy()
                norms = np.linalg.norm(vectors, axis=1)
                scores = np.round((vectors @ units.T) / norms[:, None], DIGITS)
                for q, name in enumerate(names):
                    hits = np.flatnonzero(scores[:, q] >= floors[q])
                    if len(hits) > top_k:
                        cut = np.partition(scores[hits, q], -top_k)[-top_k]
                        hits = hits[scores[hits, q] >= cut]
                    order = np.lexsort((ids[hits].astype(str), -scores[hits, q]))[:top_k]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "query_id": pa.array([name] * len(order), pa.string()),
                            "id": pa.array(ids[hits][order].tolist(), pa.string()),
                            "score": pa.array(scores[hits, q][order], pa.float64()),
                        }
                    )

    pairs = salted_join(read, probes, "cluster", ("ids",))
    return pairs.mapInArrow(score, "query_id string, id string, score double")


def _best(found: DataFrame, top_k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("position", F.row_number().over(order)).filter(
        F.col("position") <= top_k
    )


def _rounds(index: VectorIndex, queries: DataFrame, top_k: int) -> tuple[DataFrame, DataFrame]:
    """Matches of both rounds, and the probes of both."""
    asked = _asked(index, queries, top_k)
    early = _probes(index, asked)
    near = settle(_best(_compare(index, early, top_k), top_k), "near")
    floor = F.when(F.count("*") == top_k, F.min("score")).otherwise(F.lit(-2.0))
    judged = asked.join(near.groupBy("query_id").agg(floor.alias("floor")), "query_id")
    late = _probes(index, judged)
    rest = _compare(index, late, top_k)
    return near.select("query_id", "id", "score").unionByName(rest), early.unionByName(late)


def search_index(index: VectorIndex, queries: DataFrame, top_k: int = SEARCH_TOP_K) -> DataFrame:
    """Exact nearest records of many query vectors, as ``vectors.search_batch`` finds them.

    ``queries`` (``query_id`` unique, ``values``) are read in blocks by the tasks;
    none passes through the driver, only the numbers of the clusters asked for do.
    Queries without a vector or a direction find nothing, equal scores are ordered
    by id, an empty index or an empty batch gives no rows. A query vector of another
    length than the index's is refused.
    """
    check_bounds(search_top_k=top_k)
    if not len(index.numbers):
        return index.spark.createDataFrame([], "query_id string, position int, id string, score double")
    matches, _ = _rounds(index, queries, top_k)
    return _best(matches, top_k).select(
        "query_id", "position", "id", snap_round(F.col("score"), SCORE_DIGITS).alias("score")
    )


def clusters_read(index: VectorIndex, queries: DataFrame, top_k: int = SEARCH_TOP_K) -> DataFrame:
    """(query_id, clusters, vectors): what the search of each query has to read."""
    check_bounds(search_top_k=top_k)
    _, probes = _rounds(index, queries, top_k)
    listed = list(zip(index.numbers.tolist(), index.sizes.tolist()))
    sizes = index.spark.createDataFrame(listed, "cluster int, vectors long")
    asked = probes.select("cluster", F.explode("query_ids").alias("query_id"))
    return asked.join(F.broadcast(sizes), "cluster").groupBy("query_id").agg(
        F.count("*").alias("clusters"), F.sum("vectors").alias("vectors")
    )
