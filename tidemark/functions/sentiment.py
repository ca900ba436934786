"""Sentiment rules: categories, trend words, model replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.numbers import SCORE_NEUTRAL, clamp_score, safe_double, snap

# Category and trend names with their thresholds.
BULLISH, NEUTRAL, BEARISH = "BULLISH", "NEUTRAL", "BEARISH"
CATEGORIES = (BULLISH, NEUTRAL, BEARISH)
BULLISH_FROM = 7
NEUTRAL_FROM = 4
IMPROVING, DECLINING, STABLE = "IMPROVING", "DECLINING", "STABLE"


def _by_threshold(score: Column) -> Column:
    return (
        F.when(score >= BULLISH_FROM, BULLISH)
        .when(score >= NEUTRAL_FROM, NEUTRAL)
        .otherwise(BEARISH)
    )


def or_neutral(score: Column) -> Column:
    """A score, with missing and zero read as neutral."""
    return F.when(score.isNull() | (score == 0), SCORE_NEUTRAL).otherwise(score)


def row_category(score: Column) -> Column:
    """Category of one message. NaN counts as neutral: it passes no threshold."""
    usable = or_neutral(score)
    return F.when(F.isnan(usable), NEUTRAL).otherwise(_by_threshold(usable))


def hourly_category(average: Column) -> Column:
    """Category of an hour, from the average before it is rounded for display."""
    return _by_threshold(snap(average))


def trend(current: Column, previous: Column) -> Column:
    return (
        F.when(current > previous, IMPROVING)
        .when(current < previous, DECLINING)
        .otherwise(STABLE)
    )


def direction(change: Column) -> Column:
    return F.when(change > 0, "up").otherwise("down")


def parse_score_reply(reply: Column) -> Column:
    """struct(score, reasoning) from a model's JSON reply.

    No reply gives nulls. A reply that is not JSON, or holds an unusable score,
    gives a null score and says why in ``reasoning``. An absent score is
    neutral; an absent reasoning is empty; scores are kept in range.
    """
    document = F.try_parse_json(reply)
    kind = F.schema_of_variant(document)
    score = F.try_variant_get(document, "$.score", "variant")
    score_kind = F.schema_of_variant(score)
    score_text = F.try_variant_get(document, "$.score", "string")
    reasoning = F.try_variant_get(document, "$.reasoning", "variant")
    number = (
        F.when(score.isNull(), SCORE_NEUTRAL)
        .when(score_kind == "BOOLEAN", (score_text == "true").cast("double"))
        .when(~score_kind.rlike("^(OBJECT|ARRAY|VOID)"), safe_double(score_text))
    )
    silent = reply.isNull() | (reply == "")
    broken = document.isNull()
    unusable = ~kind.startswith("OBJECT") | number.isNull()
    return F.struct(
        F.when(~(silent | broken | unusable), clamp_score(number)).alias("score"),
        F.when(silent, F.lit(None).cast("string"))
        .when(broken, "Parse error: reply is not JSON")
        .when(~kind.startswith("OBJECT"), "Analysis error: reply is not an object")
        .when(number.isNull(), "Analysis error: score is not a number")
        .when(reasoning.isNull(), "")
        .otherwise(F.try_variant_get(document, "$.reasoning", "string"))
        .alias("reasoning"),
    )
