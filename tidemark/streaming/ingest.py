"""Continuous ingest into bronze, vectors and dead letters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.deadletter import split_rejects, to_dead_letter
from tidemark.operators.enrich import hashing_embedding, score_from_change
from tidemark.operators.ingest import Embedder, Scorer, enrich, vector_records
from tidemark.sources.envelope import decode_envelope
from tidemark.plans.storage import settle
from tidemark.streaming.sinks import start, write_batch


def run_ingest(
    envelopes: DataFrame,
    path: str,
    checkpoint: str,
    topic: str,
    as_of: str | datetime | None = None,
    score: Scorer = score_from_change,
    embed: Embedder = hashing_embedding,
    available_now: bool = False,
) -> StreamingQuery:
    """Decode, score and embed a stream of pushed messages.

    Each batch writes ``bronze``, ``vectors`` and ``dead_letters`` under
    ``path``, in folders of its own, and is committed once all three are
    written. Delivery is at least once; a repeated batch replaces itself.
    """

    def handle(batch: DataFrame, run: str, batch_id: int) -> None:
        now = F.current_timestamp() if as_of is None else as_of
        decoded = decode_envelope(batch)
        accepted, rejected = split_rejects(decoded)
        # Scores and vectors may come from a hosted model: made once per batch.
        enriched = settle(enrich(accepted, now, score, embed), "enriched")
        write_batch(enriched.drop("values", "metadata"), f"{path}/bronze", run, batch_id)
        write_batch(vector_records(enriched), f"{path}/vectors", run, batch_id)
        dead = to_dead_letter(rejected, "data", topic, now)
        write_batch(dead, f"{path}/dead_letters", run, batch_id)

    return start(envelopes, handle, checkpoint, available_now=available_now)
