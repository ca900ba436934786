"""Rate-limit flags on a stream.

Each micro-batch is flagged by the batch operator, which splits a hot
identifier over tasks; what goes from batch to batch is one row per open window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.ratelimit import WINDOW_SECONDS, rate_limit_step
from tidemark.streaming.sinks import batch_folder, start, write_batch


def run_rate_limit(
    requests: DataFrame,
    path: str,
    checkpoint: str,
    key: str,
    ts: str,
    limit: int,
    window_seconds: int = WINDOW_SECONDS,
    order: tuple[str, ...] = (),
    available_now: bool = False,
) -> StreamingQuery:
    """Write ``flags`` under ``path``, and ``windows``, the state after every batch.

    A batch reads the windows its predecessor left and writes its own, so it
    can be repeated. Requests later than the batches before them count as of
    their arrival, see ``rate_limit_step``.
    """

    def handle(batch: DataFrame, run: str, batch_id: int) -> None:
        before = None
        if batch_id > 0:
            before = batch.sparkSession.read.parquet(
                batch_folder(f"{path}/windows", run, batch_id - 1)
            )
        flagged, windows = rate_limit_step(
            batch, before, key, ts, limit, window_seconds, order
        )
        write_batch(windows, f"{path}/windows", run, batch_id)
        write_batch(flagged, f"{path}/flags", run, batch_id)

    return start(requests, handle, checkpoint, available_now=available_now)
