"""Who listened when: events routed by the subscriptions in force at their time.

A client's actions become changes of +1 and -1; what an event reaches is the sum of
all changes up to its time. So no event is paired with a client, and a symbol or a
client may hold any share of the rows: sums run over range pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import symbol_list
from tidemark.operators.routing import CONNECT, DISCONNECT, EVERYBODY, MODES, SUBSCRIBE, UNSUBSCRIBE
from tidemark.plans.pieces import running_sum, with_previous

#: Order within a moment: actions by their number, those that end something last.
ORDER = ["ts", "seq", "ends"]


def _states(actions: DataFrame) -> DataFrame:
    """(client, symbol, ts, seq, ends): what every action makes of a subscription.

    A disconnect ends all that its client ever subscribed to.
    """
    wanted = actions.filter(F.col("action").isin(CONNECT, SUBSCRIBE, UNSUBSCRIBE)).select(
        "client",
        F.explode(F.array_distinct(symbol_list(F.col("symbols")))).alias("symbol"),
        "ts",
        "seq",
        (F.col("action") == UNSUBSCRIBE).cast("int").alias("ends"),
    )
    wanted = wanted.filter(F.col("symbol") != "")
    gone = actions.filter(F.col("action") == DISCONNECT).select("client", "ts", "seq")
    known = wanted.select("client", "symbol").distinct()
    ended = gone.join(known, "client").withColumn("ends", F.lit(1))
    return wanted.unionByName(ended)


def _changes(states: DataFrame, by: list[str]) -> DataFrame:
    """The states that differ from the one before, as +1 or -1; at first all is off."""
    seen = with_previous(states, "ends", ORDER, by)
    change = F.coalesce("previous", F.lit(1)) - F.col("ends")
    return seen.withColumn("change", change).filter("change <> 0").drop("previous")


def subscription_changes(actions: DataFrame) -> DataFrame:
    """(client, symbol, ts, seq, ends, change): when subscriptions begin and end.

    ``actions`` are client, ts, seq, action and symbols (comma-separated). Repeated
    subscriptions, and ends of what has not begun, change nothing. Of actions with
    the same ts and seq those that end something come last.
    """
    return _changes(_states(actions), ["client", "symbol"])


def subscription_spans(actions: DataFrame) -> DataFrame:
    """(client, symbol, from_ts, to_ts): subscriptions with the time they hold.

    They hold from ``from_ts`` on and no more at ``to_ts``, which is null for those
    still in force. One that ends in the moment it began holds at no time and is left out.
    """
    changes = subscription_changes(actions)
    # Changes alternate, so the end of a span is the next one: the one before, backwards.
    backwards = changes.withColumns(
        {"_back": -F.unix_micros(F.col("ts").cast("timestamp")), "_seq": -F.col("seq"), "_ends": -F.col("ends")}
    )
    ended = with_previous(backwards, "ts", ["_back", "_seq", "_ends"], ["client", "symbol"])
    spans = ended.withColumnRenamed("previous", "to_ts").filter("change = 1")
    return spans.filter("to_ts IS NULL OR to_ts > ts").select(
        "client", "symbol", F.col("ts").alias("from_ts"), "to_ts"
    )


def connection_changes(actions: DataFrame) -> DataFrame:
    """(client, ts, seq, ends, change): when clients come and go; any action but a
    disconnect shows that a client is there."""
    ends = (F.col("action") == DISCONNECT).cast("int").alias("ends")
    return _changes(actions.select("client", "ts", "seq", ends), ["client"])


def _level_at(events: DataFrame, changes: DataFrame, by: list[str], name: str) -> DataFrame:
    """Events with the sum of the changes up to and including their ``_at``."""
    steps = changes.select(*by, F.col("ts").alias("_at"), "change", F.lit(0).alias("_kind"))
    told = events.withColumn("_kind", F.lit(1))
    both = told.unionByName(steps, allowMissingColumns=True)
    # Changes of a moment come before its events; the rest of the order only spreads rows.
    spread = F.xxhash64(*[c for c in both.columns if c not in by])
    level = running_sum(both.withColumn("_spread", spread), "change", ["_at", "_kind", "_spread"], by)
    return level.filter("_kind = 1").drop("_kind", "_spread", "change").withColumnRenamed("running", name)


def route_as_of(
    events: DataFrame,
    actions: DataFrame,
    event_id: str = "id",
    time_col: str = "ts",
    mode: str = "reference",
    dedupe: bool = False,
) -> DataFrame:
    """One row per event and channel with its recipients at the event's time.

    As ``routing.route_events``, but an action counts from its own time on, that of
    the event included: a client that joins later gets what comes later. Actions need
    not be known in advance and may lie anywhere in time. Events without a symbol
    reach the common channel only; those without a time nobody. Repeated events are
    each routed; without actions, or without events, there are no rows.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    at = F.col(time_col).alias("_at")
    addressed = events.select(F.col(event_id).alias("_id"), F.upper("symbol").alias("symbol"), at)
    addressed = addressed.filter(F.col("_at").isNotNull())
    counted = _level_at(addressed, subscription_changes(actions), ["symbol"], "own")
    channels = [F.struct(F.col("symbol").alias("channel"), F.col("own").alias("recipients"))]
    if mode == "reference":
        counted = _level_at(counted, connection_changes(actions), [], "everybody")
        rest: Column = F.col("everybody") - F.col("own") if dedupe else F.col("everybody")
        channels.append(F.struct(F.lit(EVERYBODY).alias("channel"), rest.alias("recipients")))
    return (
        counted.withColumn("_to", F.explode(F.array(*channels)))
        .select(F.col("_id").alias(event_id), "symbol", "_to.channel", "_to.recipients")
        .filter(F.col("recipients") > 0)
    )
