from datetime import datetime

import pytest

from tidemark.operators import serving

LATEST = (
    "symbol string, sentiment_score double, sentiment_category string, sentiment_trend string, "
    "price_usd double, percent_change_24h double, volume_24h double, data_points long, "
    "ai_reasoning string, last_updated timestamp_ntz"
)
NOW = datetime(2024, 1, 1, 12)
BTC = ("BTC", 7.5, "BULLISH", "IMPROVING", 67500.0, 2.5, 28e9, 150, "Strong buying", NOW)
ETH = ("ETH", 6.8, "NEUTRAL", "STABLE", 3200.0, 1.2, 15e9, 120, "Consolidation", NOW)


def row(symbol, score, category):
    return (symbol, score, category, "STABLE", 1.0, 1.0, 1.0, 1, None, NOW)


def test_lookup_in_any_letter_case(frame):
    latest = frame([BTC, ETH], LATEST)
    found = serving.symbol_sentiment(latest, "btc").collect()
    assert [(r.symbol, r.sentiment_score) for r in found] == [("BTC", 7.5)]
    assert serving.symbol_sentiment(latest, "XYZ").collect() == []


def test_category_is_matched_exactly(frame):
    latest = frame([BTC, ETH], LATEST)
    assert [r.symbol for r in serving.list_sentiments(latest).collect()] == ["BTC", "ETH"]
    assert [r.symbol for r in serving.list_sentiments(latest, 5, "NEUTRAL").collect()] == ["ETH"]
    assert serving.list_sentiments(latest, 5, "neutral").collect() == []


@pytest.mark.parametrize(
    "params",
    [
        {"limit": 1000},
        {"limit": -1},
        {"hours": 1000},
        {"hours": 0},
        {"search_top_k": 51},
        {"similar_top_k": 0},
        {"query_length": 2},
        {"min_score": 1.5},
    ],
)
def test_parameters_out_of_range(params):
    with pytest.raises(ValueError):
        serving.check_bounds(**params)


def test_parameters_in_range():
    serving.check_bounds(limit=1, hours=168, search_top_k=50, min_score=None)


def test_summary_counts_only_what_it_lists(frame):
    rows = [row(f"S{i:03d}", 1.0 + i % 9, ["BEARISH", "NEUTRAL", "BULLISH"][i % 9 // 3]) for i in range(120)]
    summary = serving.market_summary(frame(rows, LATEST), 10).first()
    assert summary.total_symbols == 10 and len(summary.symbols) == 10
    assert summary.bullish_count == 10 and summary.avg_market_sentiment == 9.0
    assert [s.symbol for s in summary.symbols] == sorted(s.symbol for s in summary.symbols)


def test_empty_summaries(frame):
    nothing = frame([], LATEST)
    assert serving.market_summary(nothing).collect() == []
    top = serving.market_summary_top(nothing).first()
    assert (top.total_symbols, top.avg_market_sentiment, top.bullish_count) == (0, 5.0, 0)
    assert top.top_bullish == [] and top.top_bearish == []


def test_top_lists(frame):
    rows = [row(f"U{i}", 7 + i / 10, "BULLISH") for i in range(7)]
    rows += [row(f"D{i}", 1 + i / 10, "BEARISH") for i in range(3)]
    top = serving.market_summary_top(frame(rows, LATEST)).first()
    assert [s.symbol for s in top.top_bullish] == ["U6", "U5", "U4", "U3", "U2"]
    assert [s.symbol for s in top.top_bearish] == ["D0", "D1", "D2"]
    ranked = serving.top_per_category(frame(rows, LATEST), 2).collect()
    assert {(r.symbol, r.position) for r in ranked} == {("U6", 1), ("U5", 2), ("D0", 1), ("D1", 2)}


def test_response_contract(frame):
    bad = frame([BTC, row("LOW", 0.5, "BEARISH")], LATEST)
    assert [r.symbol for r in serving.response_violations(bad).collect()] == ["LOW"]
    assert serving.assert_response(frame([BTC], LATEST)).count() == 1
    with pytest.raises(Exception, match="response contract"):
        serving.assert_response(bad).collect()


def test_history_bound_and_order(frame):
    schema = (
        "hour_timestamp timestamp_ntz, symbol string, avg_sentiment_score double, "
        "sentiment_category string, avg_price_usd double, avg_percent_change_24h double, "
        "avg_volume_24h double, record_count long"
    )
    hours = [(datetime(2024, 1, 1, h), "BTC", 5.0, "NEUTRAL", 1.0, 1.0, 1.0, 1) for h in range(12)]
    history = serving.symbol_history(frame(hours, schema), "btc", "2024-01-01 11:00:00", 3)
    assert [r.hour_timestamp.hour for r in history.collect()] == [11, 10, 9, 8]
    plan = history._jdf.queryExecution().toString()
    assert "upper(" not in plan
