"""Messages that a handler has failed on come back after a wait, until they are dead.

A failed message waits in the state of a stream. A timer brings it back at its next
try; after the last attempt it is dead. Messages are dealt to buckets by a hash of
their id, and a bucket works through its messages in one go, so neither a call into
Python nor a timer is paid per message.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.operators.deadletter import MAX_ATTEMPTS, MAX_BACKOFF, MIN_BACKOFF, to_dead_letter
from tidemark.sources.envelope import REFUSED
from tidemark.streaming.sinks import start, write_batch
from tidemark.streaming.stateful import start_stateful

#: What became of an attempt.
DONE, RETRY, DEAD = "done", "retry", "dead"
BUCKETS = 64
EVENT_TIME, PROCESSING_TIME = "EventTime", "ProcessingTime"
WAITING = "id string, message string, attempt int, due long"
ATTEMPTS = (
    "id string, message string, attempt int, at long, outcome string, next_try long, error string"
)
SECOND = 1_000_000

#: Makes a handler inside the worker: (id, message, attempt) -> accepted?
Handlers = Callable[[], Callable[[str, str, int], bool]]


def wait_seconds(attempt: int) -> int:
    """Wait after a failed attempt: doubled each time, within its bounds."""
    return min(MAX_BACKOFF, MIN_BACKOFF * 2 ** (attempt - 1))


class _Redelivery(StatefulProcessor):
    """Attempts of one bucket; moments are microseconds, timers milliseconds."""

    def __init__(self, make_handler: Handlers, max_attempts: int, event_time: bool):
        self.make_handler, self.max_attempts = make_handler, max_attempts
        self.event_time = event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", WAITING)
        self.timer = handle.getValueState("timer", "due long")
        self.accepts = self.make_handler()

    def _attempt(self, ident, message, attempt, at):
        """One row of the attempt, and the message if it has to wait."""
        error = None
        try:
            if not self.accepts(ident, message, attempt):
                error = REFUSED
        except Exception as raised:  # whatever a handler raises goes with the message
            error = str(raised) or type(raised).__name__
        if error is None:
            return (ident, message, attempt, at, DONE, None, None), None
        if attempt >= self.max_attempts:
            return (ident, message, attempt, at, DEAD, None, error), None
        due = at + wait_seconds(attempt) * SECOND
        return (ident, message, attempt, at, RETRY, due, error), (ident, message, attempt + 1, due)

    def _rest_until(self, due: int | None) -> None:
        """Have the bucket woken at the earliest next try, and no other time."""
        set_at = self.timer.get()[0] if self.timer.exists() else None
        if set_at == due:
            return
        if set_at is not None:
            self.handle.deleteTimer(set_at)
        if due is None:
            self.timer.clear()
        else:
            self.handle.registerTimer(due)
            self.timer.update((due,))

    @staticmethod
    def _frame(found: list) -> pd.DataFrame:
        names = [column.split()[0] for column in ATTEMPTS.split(", ")]
        return pd.DataFrame(found, columns=names).astype({"next_try": "Int64"})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = None if self.event_time else timerValues.getCurrentProcessingTimeInMs() * 1000
        earliest = self.timer.get()[0] if self.timer.exists() else None
        for frame in rows:
            found, failed = [], []
            for ident, message, at in zip(frame["id"], frame["message"], frame["at"]):
                row, later = self._attempt(ident, message, 1, int(at) if now is None else now)
                found.append(row)
                if later:
                    failed.append(later)
            if failed:
                self.waiting.appendList(failed)
                first = -(-min(due for *_, due in failed) // 1000)
                earliest = first if earliest is None else min(first, earliest)
            yield self._frame(found)
        self._rest_until(earliest)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.event_time:
            now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        else:
            now = timerValues.getCurrentProcessingTimeInMs()
        self.timer.clear()
        waiting = enumerate(self.waiting.get())
        queue = [(due, n, (ident, message, attempt)) for n, (ident, message, attempt, due) in waiting]
        heapq.heapify(queue)
        found, count = [], len(queue)
        while queue and queue[0][0] <= now * 1000:
            due, _, (ident, message, attempt) = heapq.heappop(queue)
            row, later = self._attempt(ident, message, attempt, due if self.event_time else now * 1000)
            found.append(row)
            if later:
                count += 1
                heapq.heappush(queue, (later[3], count, later[:3]))
        if queue:
            self.waiting.put([(*message, due) for due, _, message in queue])
            self._rest_until(-(-queue[0][0] // 1000))
        else:
            self.waiting.clear()
        yield self._frame(found)

    def close(self) -> None:
        pass


def attempts(
    messages: DataFrame,
    make_handler: Handlers,
    delay: str,
    max_attempts: int = MAX_ATTEMPTS,
    time_mode: str = EVENT_TIME,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Every attempt on every message (``id``, ``message``, ``at``), as a stream.

    Columns: id, message, attempt (from 1), at, outcome (done, retry or dead),
    next_try of a retry, and the error: that the handler has refused, or what it
    raised. The wait doubles with each attempt within its bounds.

    With ``EventTime`` the first attempt is at the message's own time, later ones at
    their next try, made once the stream has got ``delay`` beyond it; rows that come
    later than ``delay`` are left out by Spark, so it must cover how late messages
    are. With ``ProcessingTime`` the clock counts and nothing is late. Messages with
    equal or null ids are handled each on its own. A batch that is repeated after a
    failure may call the handler again: delivery is at least once.
    """
    if time_mode not in (EVENT_TIME, PROCESSING_TIME):
        raise ValueError(f"time_mode must be {EVENT_TIME} or {PROCESSING_TIME}")
    dealt = messages.select("id", "message", "at").withWatermark("at", delay)
    bucket = F.pmod(F.xxhash64("id", "message"), F.lit(buckets)).cast("int")
    processor = _Redelivery(make_handler, max_attempts, time_mode == EVENT_TIME)
    moved = (
        dealt.withColumn("bucket", bucket)
        .withColumn("event_time", F.col("at"))
        .withColumn("at", F.unix_micros("at"))
        .groupBy("bucket")
        .transformWithStateInPandas(processor, ATTEMPTS, "Append", time_mode)
    )
    return moved.withColumns({name: F.timestamp_micros(name) for name in ("at", "next_try")})


def run_redelivery(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    make_handler: Handlers,
    topic: str,
    delay: str,
    max_attempts: int = MAX_ATTEMPTS,
    time_mode: str = EVENT_TIME,
    available_now: bool = False,
) -> StreamingQuery:
    """Write the ``attempts`` of every batch under ``path``, and ``dead_letters``.

    ``available_now`` stops once caught up. By the clock a stream never has, as its
    timers may always fire again, so that is refused.
    """
    if available_now and time_mode == PROCESSING_TIME:
        raise ValueError("a stream that goes by the clock is never caught up")
    tried = attempts(messages, make_handler, delay, max_attempts, time_mode)

    def handle(batch: DataFrame, run: str, batch_id: int) -> None:
        kept = batch.persist()
        try:
            write_batch(kept.drop("message"), f"{path}/attempts", run, batch_id)
            dead = kept.filter(F.col("outcome") == DEAD)
            letters = to_dead_letter(dead, "message", topic, F.col("at"))
            write_batch(letters, f"{path}/dead_letters", run, batch_id)
        finally:
            kept.unpersist()

    return start_stateful(
        messages, lambda: start(tried, handle, checkpoint, available_now=available_now)
    )
