"""From raw documents to packed token sequences, stage by stage.

Each stage is a function (spark, docs, sf_dir) -> DataFrame. Its result is
written as Parquet and read again as the next one's documents, so a lost
executor never reaches back beyond its stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, linededup, neardup, packing, quality
from tidemark.plans.storage import settle


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality policy keeps."""
    return quality.apply_policy(docs, "v1")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier one."""
    return linededup.without_similar_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates."""
    return neardup.without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_leaks(docs, benchmark)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces of token sequences."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(packing.token_pieces(docs, path))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


#: Tokenizers are beyond SQL; tests/llm/test_registered.py holds run() against a plain
#: version over a small folder.
ORACLE_SQL = None
