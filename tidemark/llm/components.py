"""Connected components of a link table, in a few rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.storage import settle


def _smallest(arcs: DataFrame) -> DataFrame:
    """Every node with the smallest of itself and its neighbours."""
    least = arcs.groupBy("u").agg(F.min("v").alias("m"))
    return least.select("u", F.least("u", "m").alias("m"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): each linked node with the smallest node it can reach.

    Alternates two steps until nothing changes: every node hands its larger
    neighbours to its smallest neighbour, then its smaller ones. The number of
    rounds grows with the logarithm of the longest path. A round is written to
    shared storage, so lineage stays short and a lost executor repeats one round
    at most. Neighbours of a node are never gathered in one task: the smallest is
    an aggregate, and handing over is a join whose large partitions Spark splits.
    """
    arcs = (
        links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    )
    arcs = settle(arcs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "links")
    state = None
    while True:
        both = arcs.unionByName(arcs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        handed = both.join(_smallest(both), "u").where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")
        )
        larger = handed.where("u <> v").distinct()
        near = larger.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = _smallest(near)
        joined = near.join(least, "u")
        smaller = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        arcs = settle(smaller.where("u <> v").distinct(), "links")
        found = arcs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == state:
            break
        state = tuple(found)
    members = arcs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = arcs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)
