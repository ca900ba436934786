"""From pushed messages to bronze rows, vector records and dead letters."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import iso_text, moment
from tidemark.operators.deadletter import split_rejects, to_dead_letter
from tidemark.operators.enrich import hashing_embedding, score_from_change, vectorise
from tidemark.operators.vectors import NAMESPACE
from tidemark.sources.envelope import decode_envelope
from tidemark.plans.storage import settle

# Version and names written to the processing metadata.
FUNCTION_VERSION = "2.0.0"
DEFAULT_MODEL = "change-score"
DEFAULT_EMBEDDING_MODEL = "hashed-words"

Scorer = Callable[[DataFrame], DataFrame]
Embedder = Callable[[DataFrame, str, str], DataFrame]


class Ingested(NamedTuple):
    bronze: DataFrame
    vectors: DataFrame
    dead_letters: DataFrame


def processing_metadata(
    indexed: Column,
    processed_at: Column,
    publish_time: Column,
    model: str = DEFAULT_MODEL,
    embedding_model: str = DEFAULT_EMBEDDING_MODEL,
) -> Column:
    """JSON about how a row was processed; a missing publish time stays as null."""
    return F.to_json(
        F.struct(
            F.lit(FUNCTION_VERSION).alias("function_version"),
            F.lit(model).alias("model"),
            F.lit(embedding_model).alias("embedding_model"),
            indexed.alias("pinecone_indexed"),
            processed_at.alias("processed_at"),
            publish_time.alias("pubsub_publish_time"),
        ),
        {"ignoreNullFields": "false"},
    )


def enrich(
    accepted: DataFrame,
    as_of: str | datetime | Column,
    score: Scorer = score_from_change,
    embed: Embedder = hashing_embedding,
) -> DataFrame:
    """Accepted messages as bronze rows, with ``values`` and ``metadata`` beside.

    Narrow: scoring and embedding run where the rows are. A vector that could
    not be made only clears the indexed flag.
    """
    now = moment(as_of, "timestamp")
    stamped = iso_text(now)
    rows = vectorise(score(accepted), embed, stamped)
    return rows.select(
        F.col("message_id").alias("id"),
        F.col("payload").alias("raw_payload"),
        "source",
        now.alias("ingested_at"),
        F.col("score").alias("sentiment_score"),
        F.col("reasoning").alias("sentiment_reasoning"),
        processing_metadata(
            F.col("values").isNotNull(), stamped, F.col("publish_time")
        ).alias("processing_metadata"),
        "values",
        "metadata",
    )


def vector_records(enriched: DataFrame) -> DataFrame:
    """Vector records of the rows that have one."""
    return enriched.filter(F.col("values").isNotNull()).select(
        F.lit(NAMESPACE).alias("namespace"), "id", "values", "metadata"
    )


def ingest(
    envelopes: DataFrame,
    as_of: str | datetime | Column,
    topic: str,
    score: Scorer = score_from_change,
    embed: Embedder = hashing_embedding,
) -> Ingested:
    """Decode, score and embed pushed messages; what cannot be decoded is a dead letter."""
    accepted, rejected = split_rejects(decode_envelope(envelopes))
    # Scores and vectors may come from a hosted model: asked once per message.
    enriched = settle(enrich(accepted, as_of, score, embed), "enriched")
    return Ingested(
        enriched.drop("values", "metadata"),
        vector_records(enriched),
        to_dead_letter(rejected, "data", topic, as_of),
    )
