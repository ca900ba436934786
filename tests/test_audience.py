"""Routing by the subscriptions in force at an event's time, against a plain replay."""

import random
from datetime import datetime, timedelta

import pytest

from tidemark.operators import audience
from tidemark.operators.routing import EVERYBODY
from tidemark.plans.pieces import with_previous

ACTIONS = "client string, ts timestamp, seq long, action string, symbols string"
EVENTS = "id string, symbol string, ts timestamp"
START = datetime(2024, 1, 1)
LAST = {"connect": 0, "subscribe": 0, "unsubscribe": 1, "disconnect": 1}


def at(second):
    return START + timedelta(seconds=second)


def _replay(events, actions, dedupe=False):
    """Every event on its own, by going through all actions up to its time."""
    found = []
    for ident, symbol, when in events:
        on, here = set(), set()
        if when is None:
            continue
        for client, ts, seq, action, symbols in sorted(actions, key=lambda a: (a[1], a[2], LAST[a[3]])):
            if ts > when:
                continue
            here.discard(client) if action == "disconnect" else here.add(client)
            if action == "disconnect":
                on = {pair for pair in on if pair[0] != client}
                continue
            for one in symbols.split(","):
                pair = (client, one.strip().upper())
                on.discard(pair) if action == "unsubscribe" else on.add(pair)
        wanted = symbol and symbol.upper()
        own = sum(1 for pair in on if pair[1] == wanted)
        rest = len(here) - own if dedupe else len(here)
        found += [(ident, wanted, c, n) for c, n in ((wanted, own), (EVERYBODY, rest)) if n > 0]
    return sorted(found, key=repr)


def _routed(df):
    return sorted(((r.id, r.symbol, r.channel, r.recipients) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def history():
    """One client makes a third of all actions; moments repeat."""
    rng = random.Random(6)
    actions = []
    for seq in range(150):
        client = "hot" if seq % 3 == 0 else f"c{rng.randrange(6)}"
        action = rng.choice(["connect", "subscribe", "subscribe", "unsubscribe", "disconnect"])
        symbols = rng.choice(["btc", "eth, BTC ,btc", "sol", "btc,sol"])
        actions.append((client, at(rng.randrange(60)), seq, action, symbols))
    events = [(f"e{i}", rng.choice(["BTC", "btc", "eth", "sol", "ada", None]), at(rng.randrange(-3, 70))) for i in range(90)]
    return actions, events + [events[4], ("timeless", "btc", None)]


@pytest.mark.parametrize("dedupe", [False, True])
def test_equals_a_replay(frame, history, dedupe):
    actions, events = history
    got = audience.route_as_of(frame(events, EVENTS), frame(actions, ACTIONS), dedupe=dedupe)
    assert _routed(got) == _replay(events, actions, dedupe)


def test_subscribed_mode_has_no_common_channel(frame, history):
    actions, events = history
    got = audience.route_as_of(frame(events, EVENTS), frame(actions, ACTIONS), mode="subscribed")
    assert _routed(got) == [row for row in _replay(events, actions) if row[2] != EVERYBODY]
    with pytest.raises(ValueError):
        audience.route_as_of(frame(events, EVENTS), frame(actions, ACTIONS), mode="other")


def test_a_later_client_gets_what_comes_later(frame):
    actions = frame([("late", at(10), 1, "subscribe", "btc")], ACTIONS)
    events = frame([("before", "btc", at(9)), ("same", "btc", at(10)), ("after", "btc", at(11))], EVENTS)
    own = [r.id for r in audience.route_as_of(events, actions, mode="subscribed").collect()]
    assert sorted(own) == ["after", "same"]


def test_spans_cover_what_the_replay_says(frame, history):
    actions, _ = history
    spans = audience.subscription_spans(frame(actions, ACTIONS)).collect()
    moments = [("probe", s, at(second)) for second in range(60) for s in ("btc", "eth", "sol")]
    for ident, symbol, when in moments:
        own = [n for _, _, c, n in _replay([(ident, symbol, when)], actions) if c != EVERYBODY]
        held = [
            s for s in spans
            if s.symbol == symbol.upper() and s.from_ts <= when and (s.to_ts is None or when < s.to_ts)
        ]
        assert len(held) == (own[0] if own else 0)
        assert len({s.client for s in held}) == len(held)


def test_nothing_without_actions_or_events(frame, history):
    actions, events = history
    assert audience.route_as_of(frame([], EVENTS), frame(actions, ACTIONS)).count() == 0
    assert audience.route_as_of(frame(events, EVENTS), frame([], ACTIONS)).count() == 0


def test_previous_value_over_many_pieces(frame):
    rows = [(None if i % 5 == 0 else f"k{i % 3 * (i % 2)}", i, None if i % 7 == 0 else i * i) for i in range(200)]
    got = with_previous(frame(rows, "k string, at long, v long"), "v", ["at"], ["k"], pieces=9)
    seen, want = {}, {}
    for k, i, v in rows:
        want[i] = seen.get(k)
        seen[k] = v
    assert {r["at"]: r.previous for r in got.collect()} == want
