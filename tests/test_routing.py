import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.text import short_hash, stable_key, symbol_list
from tidemark.operators import routing

ACTIONS = "client string, ts int, seq int, action string, symbols string"


@pytest.fixture
def audience(frame):
    actions = frame(
        [
            ("a", 1, 0, "connect", " btc, Eth "),
            ("a", 2, 0, "unsubscribe", "ETH"),
            ("b", 1, 0, "connect", None),
            ("c", 1, 0, "connect", "btc"),
            ("c", 2, 0, "disconnect", None),
            ("d", 1, 0, "connect", "btc"),
            ("d", 2, 0, "disconnect", None),
            ("d", 3, 0, "connect", "sol"),
            ("e", 1, 0, "connect", "btc"),
            ("e", 1, 1, "unsubscribe", "btc"),
            ("e", 1, 2, "subscribe", "BTC"),
        ],
        ACTIONS,
    )
    return routing.current_subscriptions(actions), routing.connected_clients(actions)


@pytest.fixture
def events(frame):
    return frame([("1", "btc"), ("2", "ETH"), ("3", None)], "id string, symbol string")


def test_subscriptions_in_force(audience):
    subscriptions, clients = audience
    assert {tuple(r) for r in subscriptions.collect()} == {("a", "BTC"), ("d", "SOL"), ("e", "BTC")}
    assert {r.client for r in clients.collect()} == {"a", "b", "d", "e"}


def test_statistics(audience):
    assert {tuple(r) for r in routing.subscription_stats(*audience).collect()} == {
        ("all", 4), ("BTC", 2), ("SOL", 1)
    }


def sent(df):
    return {(r.id, r.channel, r.recipients) for r in df.collect()}


def test_every_event_goes_to_its_channel_and_to_everybody(audience, events):
    everybody = {("1", "all", 4), ("2", "all", 4), ("3", "all", 4)}
    assert sent(routing.route_events(events, *audience)) == everybody | {("1", "BTC", 2)}


def test_no_double_delivery(audience, events):
    assert sent(routing.route_events(events, *audience, dedupe=True)) == {
        ("1", "BTC", 2), ("1", "all", 2), ("2", "all", 4), ("3", "all", 4)
    }


def test_subscribed_only(audience, events):
    assert sent(routing.route_events(events, *audience, mode="subscribed")) == {("1", "BTC", 2)}
    with pytest.raises(ValueError):
        routing.route_events(events, *audience, mode="nobody")


def test_counts_and_feed(audience, events):
    counts = {tuple(r) for r in routing.delivery_counts(events, *audience).collect()}
    assert counts == {("a", 1, 3), ("b", 0, 3), ("d", 0, 3), ("e", 1, 3)}
    assert [r.id for r in routing.client_feed(events, audience[0], "a").collect()] == ["1"]
    assert routing.client_feed(events, audience[0], "d").collect() == []


MESSAGES = (
    "id string, symbol string, sentiment_score double, sentiment_category string, "
    "sentiment_reasoning string, price_usd double, percent_change_24h double"
)


def test_updates_need_a_score(frame):
    rows = [
        ("1", None, 7.0, None, None, 1.0, 1.0),
        ("2", "btc", 0.0, "BEARISH", "r", 1.0, 1.0),
        ("3", "btc", None, None, None, 1.0, 1.0),
    ]
    updates = routing.sentiment_updates(frame(rows, MESSAGES), F.lit("now")).collect()
    assert [json.loads(r.event) for r in updates] == [
        {
            "type": "sentiment_update",
            "symbol": "UNKNOWN",
            "data": {"sentiment_score": 7.0, "sentiment_category": "NEUTRAL", "reasoning": ""},
            "timestamp": "now",
        }
    ]


def test_alerts_both_ways(frame):
    rows = [(str(i), "btc", None, None, None, 1.0, c) for i, c in enumerate([5.0, -5.0, 4.9, None])]
    alerts = routing.price_alerts(frame(rows, MESSAGES), 5.0, F.lit("now")).collect()
    assert [json.loads(r.event)["data"]["direction"] for r in alerts] == ["up", "down"]


def test_subscribe_filter(frame):
    rows = [(s, s, None, None, None, None, None) for s in ("btc", "ETH", "sol")]
    df = frame(rows, MESSAGES)
    assert routing.subscribe(df).count() == 3
    assert {r.id for r in routing.subscribe(df, ["BTC", "eth"]).collect()} == {"btc", "ETH"}


def test_heartbeats(audience):
    beats = routing.heartbeats(audience[1], datetime(2024, 1, 1)).collect()
    assert len(beats) == 4
    assert json.loads(beats[0].event)["data"] == {"status": "connected"}


def test_keys_and_symbol_lists(frame):
    df = frame([("BTC", 5)], "symbol string, hours int")
    key = stable_key("lake", "s", [F.lit("x")], {"symbol": F.col("symbol"), "hours": F.col("hours")})
    assert df.select(key).first()[0] == "lake:s:x:hours=5:symbol=BTC"
    # First digits of the SHA-256 of '{"hours": 5, "symbol": "BTC"}'.
    import hashlib

    text = json.dumps({"symbol": "BTC", "hours": 5}, sort_keys=True)
    expected = hashlib.sha256(text.encode()).hexdigest()[:16]
    assert df.select(short_hash(df, ["symbol", "hours"])).first()[0] == expected
    assert df.select(symbol_list(F.lit("btc, eth ,SOL"))).first()[0] == ["BTC", "ETH", "SOL"]
