"""Text built from rows: searchable text, prompts, keys, event JSON."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.sentiment import direction

# Lengths kept of headline, article body and reasoning.
HEADLINE_CHARS = 200
CONTENT_CHARS = 500
REASONING_CHARS = 500

# The scoring prompt sent to a language model.
SCORE_PROMPT = """Analyze the following cryptocurrency market data and provide a sentiment score.

Market Data:
{market_data}

Provide your analysis as JSON with these fields:
- "score": A number from 1 to 10 (1=extremely bearish, 5=neutral, 10=extremely bullish)
- "reasoning": A brief explanation (max 100 words) of why you gave this score

Consider factors like:
- Price changes (positive/negative percentage)
- Trading volume trends
- Market cap stability
- Any news or events mentioned

Respond ONLY with valid JSON, no markdown or additional text."""

def _labelled(label: str, text: Column, present: Column) -> Column:
    return F.when(present, F.concat(F.lit(label), text))


def searchable_text(
    symbol: Column,
    price: Column,
    change: Column,
    headline: Column,
    content: Column,
    reasoning: Column,
) -> Column:
    """Labelled parts joined by `` | ``; empty, zero and missing parts are left out."""
    return F.concat_ws(
        " | ",
        _labelled("Cryptocurrency: ", symbol, symbol != ""),
        _labelled("Price: $", F.format_number(price, 2), price != 0),
        _labelled(
            "24h change: ",
            F.concat(
                direction(change),
                F.lit(" "),
                F.call_function("format_number", F.abs(change), F.lit("0.00")),
                F.lit("%"),
            ),
            change != 0,
        ),
        _labelled("News: ", headline, headline != ""),
        _labelled("Content: ", F.substring(content, 1, CONTENT_CHARS), content != ""),
        _labelled("Analysis: ", reasoning, reasoning != ""),
    )


def plain_number(value: Column) -> Column:
    """A double as text without exponent, with at least one decimal: 28500000000.0."""
    digits = value.cast("string").try_cast("decimal(38,18)").cast("string")
    return F.regexp_replace(digits, r"(\.\d+?)0+$", "$1")


def json_value(value: Column, type_name: str) -> Column:
    """One value as JSON text; doubles without exponent, a null as ``null``."""
    if type_name in ("double", "float"):
        return F.coalesce(plain_number(value), F.lit("null"))
    # to_json of a one-element array spells a value the JSON way.
    spelled = F.to_json(F.array(value), {"ignoreNullFields": "false"})
    return F.substring(spelled, F.lit(2), F.length(spelled) - 2)


def prompt_text(df: DataFrame, fields: Sequence[str]) -> Column:
    """The scoring prompt around the given payload columns, printed as indented JSON."""
    before, after = SCORE_PROMPT.split("{market_data}")
    types = dict(df.dtypes)
    lines = [
        F.concat(F.lit(f'  "{name}": '), json_value(F.col(name), types[name]))
        for name in fields
    ]
    body = F.concat(F.lit("{\n"), F.concat_ws(",\n", *lines), F.lit("\n}"))
    return F.concat(F.lit(before), body, F.lit(after))


def symbol_list(text: Column) -> Column:
    """Comma-separated symbols as an array, trimmed and upper-cased."""
    return F.transform(F.split(text, ","), lambda s: F.upper(F.trim(s)))


def event_json(kind: str, symbol: Column, data: Column, timestamp: Column) -> Column:
    """Live-event envelope {type, symbol, data, timestamp}; nulls stay in the JSON."""
    return F.to_json(
        F.struct(
            F.lit(kind).alias("type"),
            symbol.alias("symbol"),
            data.alias("data"),
            timestamp.alias("timestamp"),
        ),
        {"ignoreNullFields": "false"},
    )


def stable_key(
    prefix: str, namespace: str, args: Sequence[Column], named: Mapping[str, Column]
) -> Column:
    """prefix:namespace:arg…:name=value…, names in sorted order, nulls as ``None``."""

    def shown(value: Column) -> Column:
        return F.coalesce(value.cast("string"), F.lit("None"))

    pairs = [F.concat(F.lit(f"{name}="), shown(named[name])) for name in sorted(named)]
    return F.concat_ws(
        ":", F.lit(prefix), F.lit(namespace), *[shown(a) for a in args], *pairs
    )


def canonical_json(df: DataFrame, fields: Sequence[str]) -> Column:
    """JSON object text with sorted keys and a blank after ``:`` and ``,``."""
    types = dict(df.dtypes)
    pairs = [
        F.concat(F.lit(f'"{name}": '), json_value(F.col(name), types[name]))
        for name in sorted(fields)
    ]
    return F.concat(F.lit("{"), F.concat_ws(", ", *pairs), F.lit("}"))


def short_hash(df: DataFrame, fields: Sequence[str]) -> Column:
    """First 16 hex digits of the SHA-256 of the canonical JSON."""
    return F.substring(F.sha2(canonical_json(df, fields), 256), 1, 16)
