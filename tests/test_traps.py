"""Cases where an obvious implementation would give another result."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.numbers import clamp_score, safe_double, snap_round
from tidemark.functions.payload import extract_scalars, has_key, is_json_object
from tidemark.functions.sentiment import hourly_category, parse_score_reply, row_category
from tidemark.functions.text import searchable_text
from tidemark.operators.enrich import hashing_embedding, vectorise, with_search_text
from tidemark.operators.gold import hourly_sentiment, latest_sentiment
from tidemark.operators.staging import stage_market_data

AS_OF = "2024-01-02 00:00:00"
STAGED = (
    "id string, symbol string, price_usd double, volume_24h double, "
    "percent_change_24h double, sentiment_score double, sentiment_reasoning string, "
    "source string, ingested_at timestamp_ntz"
)
BRONZE = (
    "id string, raw_payload string, source string, ingested_at timestamp_ntz, "
    "sentiment_score double, sentiment_reasoning string, processing_metadata string"
)


def at(hour, minute=0):
    return datetime(2024, 1, 1, hour, minute)


def staged_row(symbol, score, when, reasoning="r", ident="a", source="s"):
    return (ident, symbol, 1.0, 1.0, 1.0, score, reasoning, source, when)


def values(df, expression):
    return [row[0] for row in df.select(expression).collect()]


def test_objects_and_arrays_are_no_scalars(frame):
    docs = [
        '{"a": {"b": 1}}',
        '{"a": [1]}',
        '{"a": 1.5}',
        '{"a": true}',
        '{"a": null}',
        "{}",
        '{"a": "{text}"}',
        '{"a": "[text]"}',
        "not json",
        '["a"]',
    ]
    df = extract_scalars(frame([(d,) for d in docs], "doc string"), "doc", ["a"])
    assert [r.a for r in df.collect()] == [
        None,
        None,
        "1.5",
        "true",
        None,
        None,
        "{text}",
        "[text]",
        None,
        None,
    ]


def test_only_number_text_casts(frame):
    texts = ["12.5", " 3 ", "1e3", "-.5", "1.0d", "1f", "0x1p3", "abc", "", None]
    df = frame([(t,) for t in texts], "t string")
    assert values(df, safe_double(F.col("t"))) == [
        12.5, 3.0, 1000.0, -0.5, None, None, None, None, None, None
    ]
    assert values(frame([("inf",), ("-Infinity",)], "t string"), safe_double(F.col("t"))) == [
        math.inf, -math.inf
    ]
    assert math.isnan(values(frame([("NaN",)], "t string"), safe_double(F.col("t")))[0])


def test_bad_payloads_leave_staging_quietly(frame):
    payloads = ['{"symbol": "btc", "price_usd": "12.5"}', "{broken", "[]", "{}", '{"symbol": null}']
    rows = [(str(i), p, "s", at(1), 5.0, "r", "{}") for i, p in enumerate(payloads)]
    staged = stage_market_data(frame(rows, BRONZE), AS_OF).collect()
    assert [(r.id, r.symbol, r.price_usd) for r in staged] == [("0", "btc", 12.5)]


def test_lookback_includes_its_bound(frame):
    rows = [
        (str(i), '{"symbol": "a"}', "s", when, 5.0, "r", "{}")
        for i, when in enumerate([datetime(2024, 1, 1), datetime(2023, 12, 31, 23, 59)])
    ]
    staged = stage_market_data(frame(rows, BRONZE), AS_OF, 24)
    assert [r.id for r in staged.collect()] == ["0"]


def test_rollup_by_arrival_or_by_event_time(frame):
    rows = [("1", '{"symbol": "a", "timestamp": "2024-01-01T03:20:00"}', "s", at(5), 5.0, "r", "{}")]
    staged = stage_market_data(frame(rows, BRONZE), AS_OF, with_event_time=True)
    assert hourly_sentiment(staged, AS_OF).first().hour_timestamp == at(5)
    assert hourly_sentiment(staged, AS_OF, "event_time").first().hour_timestamp == at(3)


def test_clamp_keeps_missing_scores_missing(frame):
    df = frame([(None,), (0.0,), (11.0,), (5.5,), (float("nan"),)], "s double")
    assert values(df, clamp_score(F.col("s"))) == [None, 1.0, 10.0, 5.5, 10.0]


def test_two_category_rules(frame):
    df = frame([(None,), (0.0,), (7.0,), (4.0,), (3.99,), (float("nan"),)], "s double")
    assert values(df, row_category(F.col("s"))) == [
        "NEUTRAL", "NEUTRAL", "BULLISH", "NEUTRAL", "BEARISH", "NEUTRAL"
    ]
    assert values(df, hourly_category(F.col("s")))[:5] == [
        "BEARISH", "BEARISH", "BULLISH", "NEUTRAL", "BEARISH"
    ]


def test_category_comes_before_rounding(frame):
    rows = [staged_row("a", s, at(1)) for s in (6.993, 6.999)]
    hour = hourly_sentiment(frame(rows, STAGED), AS_OF).first()
    assert (hour.avg_sentiment_score, hour.sentiment_category) == (7.0, "NEUTRAL")


def test_rounding_is_half_up_on_the_decimal(frame):
    df = frame([(0.285,), (2.675,), (-0.125,), (1e30,), (float("nan"),)], "x double")
    got = values(df, snap_round(F.col("x"), 2))
    assert got[:4] == [0.29, 2.68, -0.13, 1e30] and math.isnan(got[4])


def test_average_of_tenths_reaches_the_threshold(frame):
    rows = [staged_row("a", s, at(1)) for s in (3.9, 4.1, 3.7, 4.3, 4.2, 3.8)]
    hour = hourly_sentiment(frame(rows, STAGED), AS_OF).first()
    assert (hour.avg_sentiment_score, hour.sentiment_category) == (4.0, "NEUTRAL")


def test_letter_case_of_symbols_is_merged(frame):
    rows = [staged_row("btc", 4.0, at(1)), staged_row("BTC", 6.0, at(1, 30))]
    hours = hourly_sentiment(frame(rows, STAGED), AS_OF).collect()
    assert [(h.symbol, h.record_count, h.avg_sentiment_score) for h in hours] == [("BTC", 2, 5.0)]


def test_one_row_has_no_deviation_and_null_source_is_not_counted(frame):
    rows = [staged_row("a", 4.0, at(1), source=None)]
    hour = hourly_sentiment(frame(rows, STAGED), AS_OF).first()
    assert hour.sentiment_stddev is None and hour.source_count == 0


def test_latest_reasoning_may_be_null(frame):
    rows = [
        staged_row("a", 4.0, at(1), "old"),
        staged_row("a", 4.0, at(1, 30), None),
        staged_row("a", None, at(1, 50), "not scored"),
    ]
    assert hourly_sentiment(frame(rows, STAGED), AS_OF).first().latest_reasoning is None


def test_trend_modes(frame):
    rows = [
        staged_row("up", 4.0, at(1)),
        staged_row("up", 6.0, at(3)),
        staged_row("down", 6.0, at(1)),
        staged_row("down", 4.0, at(2)),
        staged_row("once", 4.0, at(2)),
    ]
    hourly = hourly_sentiment(frame(rows, STAGED), AS_OF)
    fixed = {r.symbol: r.sentiment_trend for r in latest_sentiment(hourly).collect()}
    real = {
        r.symbol: (r.sentiment_trend, r.last_updated)
        for r in latest_sentiment(hourly, "previous_hour").collect()
    }
    assert set(fixed.values()) == {"STABLE"}
    assert real == {
        "UP": ("IMPROVING", at(3)),
        "DOWN": ("DECLINING", at(2)),
        "ONCE": ("STABLE", at(2)),
    }
    with pytest.raises(ValueError):
        latest_sentiment(hourly, "other")


def test_absent_and_null_keys_differ(frame):
    df = frame([('{"a": null}',), ("{}",), ("[1]",), ("bad",)], "d string")
    assert values(df, has_key(F.col("d"), "a")) == [True, False, False, False]
    assert values(df, is_json_object(F.col("d"))) == [True, True, False, False]


@pytest.mark.parametrize(
    "reply, score, reasoning",
    [
        (None, None, None),
        ("", None, None),
        ("nope", None, "Parse error"),
        ("[1]", None, "Analysis error"),
        ('{"score": null}', None, "Analysis error"),
        ('{"score": "x"}', None, "Analysis error"),
        ('{"score": [1]}', None, "Analysis error"),
        ("{}", 5.0, ""),
        ('{"score": true, "reasoning": null}', 1.0, None),
        ('{"score": "8.5", "reasoning": "good"}', 8.5, "good"),
        ('{"score": -3}', 1.0, ""),
        ('{"score": 99}', 10.0, ""),
    ],
)
def test_model_replies(frame, reply, score, reasoning):
    parsed = frame([(reply,)], "r string").select(parse_score_reply(F.col("r")).alias("p")).first().p
    assert parsed.score == score
    if reasoning is None:
        assert parsed.reasoning is None
    else:
        assert parsed.reasoning.startswith(reasoning)


def test_searchable_text_leaves_out_empty_parts(frame):
    rows = [
        ("BTC", 67500.0, 2.5, "News here", "x" * 600, "why"),
        ("BTC", 0.0, 0.0, "", None, None),
        (None, 0.125, -2.675, None, "", ""),
    ]
    df = frame(rows, "s string, p double, c double, h string, n string, r string")
    text = searchable_text(*[F.col(c) for c in "spchnr"])
    assert values(df, text) == [
        "Cryptocurrency: BTC | Price: $67,500.00 | 24h change: up 2.50% | News: News here | "
        f"Content: {'x' * 500} | Analysis: why",
        "Cryptocurrency: BTC",
        f"Price: ${0.125:,.2f} | 24h change: down {2.675:.2f}%",
    ]


def test_vector_is_skipped_where_the_payload_does_not_allow_it(frame):
    payloads = [
        '{"symbol": "btc", "price_usd": 1.5, "news_headline": "up"}',
        '{"symbol": "btc"}',
        '{"price_usd": 2}',
        '{"symbol": null}',
        '{"symbol": "btc", "news_headline": null}',
        '{"symbol": "btc", "price_usd": "1.5"}',
        "{}",
    ]
    df = frame(
        [(p, 5.0 if i else 0.0, None) for i, p in enumerate(payloads)],
        "payload string, score double, reasoning string",
    )
    rows = vectorise(df, hashing_embedding, F.lit("now")).collect()
    assert [r["values"] is not None for r in rows] == [True, True, True, False, False, False, False]
    first = rows[0].metadata
    assert (first.symbol, first.source, first.sentiment_score, first.sentiment_category) == (
        "BTC", "unknown", 5.0, "NEUTRAL"
    )
    assert rows[2].metadata.symbol == "UNKNOWN" and rows[1].metadata.news_headline == ""
    assert sum(x * x for x in rows[0]["values"]) == pytest.approx(1.0, abs=1e-5)


def test_text_with_prices_that_are_no_numbers(frame):
    payloads = [
        '{"symbol": "a", "price_usd": ""}',
        '{"symbol": "a", "price_usd": {}}',
        '{"symbol": "a", "price_usd": "2", "percent_change_24h": 1}',
    ]
    df = frame([(p, None) for p in payloads], "payload string, reasoning string")
    rows = with_search_text(df, "payload", "reasoning").collect()
    assert [r.search_text for r in rows] == ["Cryptocurrency: a", None, None]


def test_symbols_that_are_no_text_get_no_vector(frame):
    payloads = ['{"symbol": 5}', '{"symbol": "5"}', '{"symbol": true}', '{"symbol": "true"}', '{"symbol": {"a": 1}}']
    df = frame([(p, 5.0, None) for p in payloads], "payload string, score double, reasoning string")
    rows = vectorise(df, hashing_embedding, F.lit("now")).collect()
    assert [r["values"] is not None for r in rows] == [False, True, False, True, False]
