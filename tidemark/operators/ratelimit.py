"""Rate-limit flags with windows anchored at an identifier's first request.

A window opens with a request, lasts a fixed time, and counts every request in
it, refused ones too; the first request after its end opens the next. Where a
window starts depends on the one before, so a key's requests form a chain. The
chain is cut into range pieces: every piece works out alone how it hands the
open window on, neighbouring hand-overs are put together in the tasks, and then
every piece numbers its rows. Only key, time, weight and row number go through
Python, batch after batch; the other columns are joined back in the JVM.

Rows have a weight: one for a request, and for a window still open from before
the number of requests it has already counted, placed at the window's start.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import epoch_micros
from tidemark.plans.pieces import PIECE
from tidemark.plans.storage import settle

# Fixed value: length of a window when none is given, in seconds.
WINDOW_SECONDS = 60

# Rows of one piece, of which a task holds times and weights.
PIECE_ROWS = 250_000

# Neighbouring hand-overs put together by one task.
FAN_IN = 16

_HANDOVER_SCHEMA = (
    "block bigint, first_key string, last_key string, single boolean, "
    "first_us bigint, last_us bigint, weight bigint, anchor_us bigint, count bigint, "
    "entries array<bigint>, anchors array<bigint>, counts array<bigint>"
)

Open = tuple[str, int, int]  # key, start of the open window in microseconds, requests in it

US, WEIGHT, ANCHOR, ROW, KEY = "_us", "_weight", "_anchor", "_row", "_key"


class Handover(NamedTuple):
    """How a block of neighbouring pieces hands the open window on.

    ``anchor_us`` and ``count`` are the window it leaves open when none of its
    first key comes in. With a single key the outcome depends on when the
    window brought along ends: ``entries`` are the times of requests that may
    open the first window here, ``anchors`` and ``counts`` what comes of it. Of
    entries with the same outcome the last is kept.
    """

    block: int
    first_key: str
    last_key: str
    single: bool
    first_us: int
    last_us: int
    weight: int
    anchor_us: int
    count: int
    entries: np.ndarray
    anchors: np.ndarray
    counts: np.ndarray

    def left_open(self, brought: Open | None, window_us: int) -> Open:
        """The window open after this block, by the one open before it."""
        if brought is None or not self.single or brought[0] != self.first_key:
            return self.last_key, self.anchor_us, self.count
        key, anchor, count = brought
        anchors, counts = self._after(np.array([anchor]), np.array([count]), window_us)
        return key, int(anchors[0]), int(counts[0])

    def _after(
        self, anchors: np.ndarray, counts: np.ndarray, window_us: int
    ) -> tuple[np.ndarray, np.ndarray]:
        ends = anchors + window_us
        passed = ends > self.last_us
        entry = np.where(passed, 0, np.searchsorted(self.entries, ends, side="left"))
        return (
            np.where(passed, anchors, self.anchors[entry]),
            np.where(passed, counts + self.weight, self.counts[entry]),
        )

    def then(self, other: Handover, window_us: int) -> Handover:
        """Both blocks as one; ``other`` follows this."""
        _, anchor, count = other.left_open(
            (self.last_key, self.anchor_us, self.count), window_us
        )
        single = self.single and other.single and self.last_key == other.first_key
        entries = anchors = counts = np.empty(0, dtype="int64")
        if single:
            entries = self.entries
            anchors, counts = other._after(self.anchors, self.counts, window_us)
            # A window brought along may end after this block.
            latest = self.first_us + window_us
            if self.last_us < latest:
                more = int(np.searchsorted(other.entries, latest, side="left")) + 1
                entries = np.concatenate([entries, other.entries[:more]])
                anchors = np.concatenate([anchors, other.anchors[:more]])
                counts = np.concatenate([counts, other.counts[:more]])
            entries, anchors, counts = _distinct(entries, anchors, counts)
        return Handover(
            self.block, self.first_key, other.last_key, single, self.first_us,
            other.last_us, self.weight + other.weight, anchor, count,
            entries, anchors, counts,
        )


def _distinct(
    entries: np.ndarray, anchors: np.ndarray, counts: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The last of neighbouring entries with one outcome."""
    last = np.append((anchors[1:] != anchors[:-1]) | (counts[1:] != counts[:-1]), True)
    return entries[last], anchors[last], counts[last]


def _of_piece(
    piece: int, first: str, last: str, single: bool, times: np.ndarray,
    weights: np.ndarray, window_us: int,
) -> Handover:
    """Hand-over of one piece by the sorted times of its last key."""
    n = len(times)
    # Weight from each row to the end of the piece.
    rest = weights[::-1].cumsum()[::-1]
    # Follow "first request after my window" to the last window start.
    step = np.searchsorted(times, times + window_us, side="left")
    end = np.arange(n)
    while (step < n).any():
        inner = step < n
        end[inner] = end[step[inner]]
        step[inner] = step[step[inner]]
    entries = anchors = counts = np.empty(0, dtype="int64")
    if single:
        reach = int(np.searchsorted(times, times[0] + window_us, side="left"))
        at = end[: reach + 1]
        entries, anchors, counts = _distinct(times[: reach + 1], times[at], rest[at])
    return Handover(
        piece, first, last, single, int(times[0]), int(times[-1]), int(rest[0]),
        int(times[end[0]]), int(rest[end[0]]), entries, anchors, counts,
    )


def _runs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(pieces, positions at which piece or key changes) of a batch in order."""
    pieces = batch.column(PIECE).to_numpy()
    keys = batch.column(KEY)
    changed = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
    return pieces, np.flatnonzero(changed | (pieces[1:] != pieces[:-1])) + 1


def _handovers(narrow: DataFrame, window_us: int) -> DataFrame:
    """One row per piece; ``narrow`` is in order and holds whole pieces in a partition."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {
            "first_key": pa.string(), "last_key": pa.string(), "single": pa.bool_(),
            "entries": pa.list_(pa.int64()), "anchors": pa.list_(pa.int64()),
            "counts": pa.list_(pa.int64()),
        }

        def row(piece, first, last, single, times, weights):
            found = _of_piece(
                piece, first, last, single, np.concatenate(times),
                np.concatenate(weights), window_us,
            )
            return pa.RecordBatch.from_arrays(
                [pa.array([v], types.get(n, pa.int64())) for n, v in found._asdict().items()],
                names=list(Handover._fields),
            )

        piece = None
        for batch in batches:
            if not batch.num_rows:
                continue
            pieces, edges = _runs(batch)
            us, weight = batch.column(US).to_numpy(), batch.column(WEIGHT).to_numpy()
            keys = batch.column(KEY)
            starts = np.append(0, np.flatnonzero(pieces[1:] != pieces[:-1]) + 1)
            for a, b in zip(starts, np.append(starts[1:], len(us))):
                # Only the last key of the piece hands a window on.
                inside = edges[(edges > a) & (edges < b)]
                tail = int(inside[-1]) if len(inside) else a
                here = keys[int(a)].as_py()
                if piece != int(pieces[a]):
                    if piece is not None:
                        yield row(piece, first, last, single, times, weights)
                    piece, first, last, single = int(pieces[a]), here, here, True
                    times, weights = [], []
                if len(inside) or here != last:
                    single, last = False, keys[tail].as_py() if len(inside) else here
                    times, weights = [], []
                times.append(us[tail:b])
                weights.append(weight[tail:b])
        if piece is not None:
            yield row(piece, first, last, single, times, weights)

    return narrow.mapInArrow(summarise, _HANDOVER_SCHEMA)


def _blocks(frame: pd.DataFrame) -> list[Handover]:
    rows = frame.sort_values("block")[list(Handover._fields)].itertuples(index=False)
    arrays = ("entries", "anchors", "counts")
    return [
        (h := Handover(*r))._replace(
            **{a: np.asarray(getattr(h, a), dtype="int64") for a in arrays}
        )
        for r in rows
    ]


def _put_together(level: DataFrame, window_us: int) -> DataFrame:
    """Hand-overs of FAN_IN neighbours as one; gives the next level."""

    def compose(frame: pd.DataFrame) -> pd.DataFrame:
        blocks = _blocks(frame)
        whole = blocks[0]
        for block in blocks[1:]:
            whole = whole.then(block, window_us)
        whole = whole._replace(block=whole.block // FAN_IN)
        return pd.DataFrame([whole], columns=list(Handover._fields))

    return level.groupBy(_parent()).applyInPandas(compose, _HANDOVER_SCHEMA)


def _parent() -> Column:
    return F.floor(F.col("block") / FAN_IN).alias("parent")


def _brought(level: DataFrame, above: DataFrame | None, window_us: int) -> DataFrame:
    """(block, key, anchor_us, count) of each block with a window open before it."""

    def walk(frame: pd.DataFrame) -> pd.DataFrame:
        opened = None
        if bool(frame["_open"].iloc[0]):
            opened = tuple(frame[["_key", "_anchor", "_count"]].iloc[0])
        found = []
        for block in _blocks(frame):
            if opened is not None and opened[0] == block.first_key:
                found.append((block.block, *opened))
            opened = block.left_open(opened, window_us)
        return pd.DataFrame(found, columns=["block", KEY, "anchor_us", "count"])

    if above is None:
        given = level.select(
            "*", F.lit(False).alias("_open"), F.lit("").alias("_key"),
            F.lit(0).cast("bigint").alias("_anchor"), F.lit(0).cast("bigint").alias("_count"),
        )
    else:
        state = above.select(
            F.col("block").alias("_parent"), F.col(KEY).alias("_above_key"),
            F.col("anchor_us").alias("_above_anchor"), F.col("count").alias("_above_count"),
        )
        zero = F.lit(0).cast("bigint")
        given = level.join(state, _parent() == F.col("_parent"), "left").select(
            *level.columns,
            F.col("_parent").isNotNull().alias("_open"),
            F.coalesce("_above_key", F.lit("")).alias("_key"),
            F.coalesce("_above_anchor", zero).alias("_anchor"),
            F.coalesce("_above_count", zero).alias("_count"),
        )
    schema = f"block bigint, {KEY} string, anchor_us bigint, count bigint"
    return given.groupBy(_parent()).applyInPandas(walk, schema)


def _open_windows(handovers: DataFrame, window_us: int) -> DataFrame:
    """The window open at the start of every piece whose first key came in open.

    Blocks of FAN_IN neighbours are put together level by level, then every
    block tells its parts what they are brought. The number of Spark jobs grows
    with the logarithm of the number of pieces.
    """
    levels = [handovers]
    blocks = (handovers.agg(F.max("block")).first()[0] or 0) + 1
    while blocks > FAN_IN:
        levels.append(settle(_put_together(levels[-1], window_us), "handovers"))
        blocks = -(-blocks // FAN_IN)
    opened = None
    for level in reversed(levels):
        opened = settle(_brought(level, opened, window_us), "opened")
    return opened


def _numbered(
    rows: DataFrame, key: str, order: list[str], window_us: int, pieces: int | None
) -> DataFrame:
    """Rows (with time and weight) with the start of their window and their number in it.

    Range bounds are sampled, so the cut rows are written out with their row
    numbers; a re-run after a lost executor must not cut elsewhere.
    """
    count = pieces or max(1, -(-rows.count() // PIECE_ROWS))
    by = [key, US, *order]
    ranged = rows.repartitionByRange(count, *by).sortWithinPartitions(*by)
    cut = settle(
        ranged.withColumns({PIECE: F.spark_partition_id(), ROW: F.monotonically_increasing_id()}),
        "pieces",
    )
    narrow = cut.select(PIECE, ROW, F.col(key).cast("string").alias(KEY), US, WEIGHT)

    def in_order(df: DataFrame) -> DataFrame:
        return df.repartitionById(count, F.col(PIECE)).sortWithinPartitions(PIECE, ROW)

    handovers = settle(_handovers(in_order(narrow), window_us), "handovers")
    # A window brought along is a row before the piece's first.
    brought = _open_windows(handovers, window_us).select(
        F.col("block").cast("int").alias(PIECE), F.lit(-1).cast("bigint").alias(ROW), KEY,
        F.col("anchor_us").alias(US), F.col("count").alias(WEIGHT),
    )

    def number_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, anchor, count = None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            pieces, edges = _runs(batch)
            us, weight = batch.column(US).to_numpy(), batch.column(WEIGHT).to_numpy()
            keys = batch.column(KEY)
            anchors = np.empty(len(us), dtype="int64")
            numbers = np.empty(len(us), dtype="int64")
            bounds = [0, *edges.tolist(), len(us)]
            for start, stop in zip(bounds, bounds[1:]):
                here = (int(pieces[start]), keys[start].as_py())
                i = start
                while i < stop:
                    if here != run or us[i] >= anchor + window_us:
                        run, anchor, count = here, int(us[i]), 0
                    j = i + int(np.searchsorted(us[i:stop], anchor + window_us, side="left"))
                    anchors[i:j] = anchor
                    numbers[i:j] = count + weight[i:j].cumsum()
                    count = int(numbers[j - 1])
                    i = j
            yield pa.RecordBatch.from_arrays(
                [batch.column(ROW), pa.array(anchors), pa.array(numbers)],
                names=[ROW, ANCHOR, "request_number"],
            )

    numbers = in_order(narrow.unionByName(brought)).mapInArrow(
        number_rows, f"{ROW} bigint, {ANCHOR} bigint, request_number bigint"
    )
    return cut.drop(PIECE).join(numbers.filter(F.col(ROW) >= 0), ROW).drop(ROW)


def _verdict(limit: int) -> dict[str, Column]:
    number = F.col("request_number")
    return {
        "allowed": number <= limit,
        "remaining": F.greatest(F.lit(0), limit - number).cast("bigint"),
    }


def _weighted(requests: DataFrame, key: str, ts: str) -> DataFrame:
    return requests.filter(F.col(key).isNotNull()).withColumns(
        {US: epoch_micros(F.col(ts)), WEIGHT: F.lit(1).cast("bigint")}
    )


def _without_key(requests: DataFrame, key: str, limit: int) -> DataFrame:
    """Requests nobody can be counted for: allowed, with the full rest."""
    return requests.filter(F.col(key).isNull()).withColumns(
        {
            "request_number": F.lit(0).cast("bigint"),
            "allowed": F.lit(True),
            "remaining": F.lit(limit).cast("bigint"),
        }
    )


def rate_limit(
    requests: DataFrame,
    key: str,
    ts: str,
    limit: int,
    window_seconds: int = WINDOW_SECONDS,
    order: tuple[str, ...] = (),
    pieces: int | None = None,
) -> DataFrame:
    """Add ``request_number``, ``allowed`` and ``remaining`` to every request.

    ``order`` breaks ties between requests of one moment and should make rows
    unique. Requests without a key are allowed with the full rest, as when no
    counter can be reached.
    """
    numbered = _numbered(
        _weighted(requests, key, ts), key, list(order), window_seconds * 1_000_000, pieces
    )
    flagged = numbered.drop(US, WEIGHT, ANCHOR).withColumns(_verdict(limit))
    return flagged.unionByName(_without_key(requests, key, limit))


def rate_limit_step(
    requests: DataFrame,
    open_windows: DataFrame | None,
    key: str,
    ts: str,
    limit: int,
    window_seconds: int = WINDOW_SECONDS,
    order: tuple[str, ...] = (),
    pieces: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(flagged requests, open windows after them) for the next part of a stream.

    ``open_windows`` (key, anchor_us, counted, clock_us) is what the step before
    returned. Windows that ended before the newest request are dropped from it.

    A request that comes late, with a time before the newest one of earlier parts,
    counts as of its arrival: at that newest time (``clock_us``). It so falls into
    the window that is open, cannot move one back and cannot open one in the past;
    its own time column stays as it is. Within a part requests count by their time.
    """
    window_us = window_seconds * 1_000_000
    rows = _weighted(requests, key, ts).withColumn("_request", F.lit(True))
    clock = F.lit(None).cast("bigint")
    if open_windows is not None:
        clock = open_windows.agg(F.max("clock_us")).scalar()
        rows = rows.withColumn(US, F.greatest(US, clock))
        earlier = open_windows.select(
            key,
            F.col("anchor_us").alias(US),
            F.col("counted").alias(WEIGHT),
            F.lit(False).alias("_request"),
        )
        rows = rows.unionByName(earlier, allowMissingColumns=True)
    numbered = settle(
        # What is counted already comes before a request of the same moment.
        _numbered(rows, key, ["_request", *order], window_us, pieces),
        "numbered",
    )
    flagged = (
        numbered.filter("_request")
        .drop(US, WEIGHT, ANCHOR, "_request")
        .withColumns(_verdict(limit))
    )
    newest = F.greatest(numbered.agg(F.max(US)).scalar(), clock)
    last = F.max(F.struct(ANCHOR, "request_number")).alias("_last")
    still_open = (
        numbered.groupBy(key)
        .agg(last)
        .select(
            key,
            F.col(f"_last.{ANCHOR}").alias("anchor_us"),
            F.col("_last.request_number").alias("counted"),
            newest.alias("clock_us"),
        )
        .filter(F.col("anchor_us") + window_us > F.col("clock_us"))
    )
    return flagged.unionByName(_without_key(requests, key, limit)), still_open
