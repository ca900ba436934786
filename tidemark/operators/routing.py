"""Live events: what is sent, who is subscribed, who receives what.

An event is addressed to channels, one per symbol and one for everybody, and
carries the number of its recipients; the pairs of event and client are not
written out, they multiply. A client's own feed is read by its subscriptions.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.sentiment import NEUTRAL, direction
from tidemark.functions.text import event_json, symbol_list
from tidemark.functions.vectors import UNKNOWN_SYMBOL
from tidemark.plans.skew import salted_join

# Event type names, actions of clients, and the common channel.
SENTIMENT_UPDATE = "sentiment_update"
PRICE_ALERT = "price_alert"
TREND_CHANGE = "trend_change"
SYSTEM_STATUS = "system_status"
HEARTBEAT = "heartbeat"
CONNECT, SUBSCRIBE, UNSUBSCRIBE, DISCONNECT = (
    "connect",
    "subscribe",
    "unsubscribe",
    "disconnect",
)
EVERYBODY = "all"
MODES = ("reference", "subscribed")


def sentiment_updates(messages: DataFrame, timestamp: Column) -> DataFrame:
    """Update events of messages with a score; none and zero send nothing."""
    score = F.col("sentiment_score")
    symbol = F.coalesce("symbol", F.lit(UNKNOWN_SYMBOL))
    data = F.struct(
        score.alias("sentiment_score"),
        F.coalesce("sentiment_category", F.lit(NEUTRAL)).alias("sentiment_category"),
        F.coalesce("sentiment_reasoning", F.lit("")).alias("reasoning"),
    )
    return messages.filter(score.isNotNull() & (score != 0)).select(
        "id",
        symbol.alias("symbol"),
        event_json(SENTIMENT_UPDATE, symbol, data, timestamp).alias("event"),
    )


def price_alerts(messages: DataFrame, threshold: float, timestamp: Column) -> DataFrame:
    """Alert events where the price moved by at least ``threshold`` percent either way."""
    change = F.col("percent_change_24h")
    data = F.struct(
        F.col("price_usd"),
        change.alias("change_percent"),
        direction(change).alias("direction"),
    )
    return messages.filter(F.abs(change) >= threshold).select(
        "id",
        "symbol",
        event_json(PRICE_ALERT, F.col("symbol"), data, timestamp).alias("event"),
    )


def trend_events(changes: DataFrame, timestamp: Column) -> DataFrame:
    """Trend-change events from the hours whose trend turned."""
    data = F.struct(
        F.col("previous_trend"),
        F.col("sentiment_trend"),
        F.col("avg_sentiment_score").alias("sentiment_score"),
    )
    return changes.select(
        "symbol",
        "hour_timestamp",
        event_json(TREND_CHANGE, F.col("symbol"), data, timestamp).alias("event"),
    )


def subscribe(messages: DataFrame, symbols: list[str] | None = None) -> DataFrame:
    """Messages of the wanted symbols, any letter case; none given means all."""
    if not symbols:
        return messages
    return messages.filter(F.upper("symbol").isin([s.upper() for s in symbols]))


def connected_clients(actions: DataFrame) -> DataFrame:
    """Clients whose last action (client, ts, seq, action) is not a disconnect."""
    last = F.max(F.struct("ts", "seq", "action")).alias("_last")
    return (
        actions.groupBy("client")
        .agg(last)
        .filter(F.col("_last.action") != DISCONNECT)
        .select("client")
    )


def current_subscriptions(actions: DataFrame) -> DataFrame:
    """(client, symbol) pairs in force after all actions.

    Columns: client, ts, seq (order within a moment), action, symbols
    (comma-separated). The last action per client and symbol decides; a later
    disconnect removes everything the client had. A client's actions are
    reduced to one row per symbol before the join.
    """
    wanted = actions.filter(F.col("action").isin(CONNECT, SUBSCRIBE, UNSUBSCRIBE))
    moment = F.struct("ts", "seq")
    last = (
        wanted.select(
            "client", "ts", "seq", "action", F.explode(symbol_list(F.col("symbols"))).alias("symbol")
        )
        .filter(F.col("symbol") != "")
        .groupBy("client", "symbol")
        .agg(F.max(F.struct(moment.alias("at"), "action")).alias("_last"))
        .filter(F.col("_last.action") != UNSUBSCRIBE)
    )
    gone = (
        actions.filter(F.col("action") == DISCONNECT)
        .groupBy("client")
        .agg(F.max(moment).alias("_off"))
    )
    return (
        last.join(gone, "client", "left")
        .filter(F.col("_off").isNull() | (F.col("_last.at") > F.col("_off")))
        .select("client", "symbol")
    )


def _subscribers(subscriptions: DataFrame) -> DataFrame:
    """Subscribers per upper-cased symbol; pairs are unique already."""
    return subscriptions.groupBy(F.upper("symbol").alias("symbol")).agg(
        F.count("*").alias("recipients")
    )


def subscription_stats(subscriptions: DataFrame, clients: DataFrame) -> DataFrame:
    """Connected clients in all, and subscribers of each symbol."""
    total = clients.agg(F.count("*").alias("clients")).select(
        F.lit(EVERYBODY).alias("channel"), "clients"
    )
    by_symbol = _subscribers(subscriptions).select(
        F.col("symbol").alias("channel"), F.col("recipients").alias("clients")
    )
    return total.unionByName(by_symbol)


def route_events(
    events: DataFrame,
    subscriptions: DataFrame,
    clients: DataFrame,
    event_id: str = "id",
    mode: str = "reference",
    dedupe: bool = False,
) -> DataFrame:
    """One row per event and channel with its number of recipients.

    Every event goes to the channel of its symbol, if that has subscribers,
    and (``reference``) to everybody, so a subscriber gets it twice. ``dedupe``
    leaves subscribers out of the common channel. Channels without recipients
    are left out.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    addressed = events.withColumn("symbol", F.upper("symbol"))
    counted = salted_join(
        addressed, _subscribers(subscriptions), "symbol", [event_id], "left"
    )
    own = F.coalesce("recipients", F.lit(0))
    channels = [F.struct(F.col("symbol").alias("channel"), own.alias("recipients"))]
    if mode == "reference":
        everybody = clients.agg(F.count("*")).scalar()
        rest = everybody - own if dedupe else everybody
        channels.append(
            F.struct(F.lit(EVERYBODY).alias("channel"), rest.alias("recipients"))
        )
    return (
        counted.select(event_id, "symbol", F.explode(F.array(*channels)).alias("_to"))
        .select(event_id, "symbol", "_to.channel", "_to.recipients")
        .filter(F.col("recipients") > 0)
    )


def delivery_counts(
    events: DataFrame, subscriptions: DataFrame, clients: DataFrame
) -> DataFrame:
    """Messages each connected client receives, by symbol channel and in the common one.

    Events are counted per symbol before they meet the subscriptions.
    """
    per_symbol = events.groupBy(F.upper("symbol").alias("symbol")).agg(
        F.count("*").alias("_events")
    )
    wanted = subscriptions.select("client", F.upper("symbol").alias("symbol"))
    direct = (
        salted_join(wanted, per_symbol, "symbol", ["client"])
        .groupBy("client")
        .agg(F.sum("_events").alias("by_symbol"))
    )
    total = events.agg(F.count("*")).scalar()
    return clients.join(direct, "client", "left").select(
        "client",
        F.coalesce("by_symbol", F.lit(0)).alias("by_symbol"),
        total.alias("broadcast"),
    )


def client_feed(events: DataFrame, subscriptions: DataFrame, client: str) -> DataFrame:
    """Events on the symbol channels of one client."""
    wanted = (
        subscriptions.filter(F.col("client") == client)
        .select(F.upper("symbol").alias("symbol"))
        .distinct()
    )
    addressed = events.withColumn("symbol", F.upper("symbol"))
    return salted_join(addressed, wanted, "symbol", ["id"])


def heartbeats(clients: DataFrame, as_of: str | datetime) -> DataFrame:
    """A heartbeat event per connected client."""
    data = F.struct(F.lit("connected").alias("status"))
    text = as_of.isoformat() if isinstance(as_of, datetime) else as_of
    event = event_json(HEARTBEAT, F.lit(None).cast("string"), data, F.lit(text))
    return clients.select("client", event.alias("event"))
