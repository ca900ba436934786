"""Scoring and embedding of messages, with pluggable models.

The default scorer and embedder run inside the JVM and need no model file.
Hosted models plug in through a client factory: one client per task, called
with a batch of texts at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numbers import SCORE_NEUTRAL, clamp_score, safe_double
from tidemark.functions.payload import string_only
from tidemark.functions.sentiment import parse_score_reply
from tidemark.functions.text import searchable_text
from tidemark.functions.vectors import vector_metadata
from tidemark.plans.once import compute_once

EMBEDDING_DIMS = 256
CLIENT_BATCH = 64

# A client takes a list of texts and returns one reply per text; an exception
# in place of a reply marks a failed call.
TextClient = Callable[[Sequence[str]], Sequence[object]]


def score_from_change(df: DataFrame) -> DataFrame:
    """Default scorer: neutral plus the 24h change, kept in range.

    A payload without a usable change has no score, and its reasoning says so.
    """
    change = safe_double(F.get_json_object("payload", "$.percent_change_24h"))
    scored = compute_once(df, {"_change": change})
    value = F.col("_change")
    return scored.withColumns(
        {
            "score": clamp_score(SCORE_NEUTRAL + value),
            "reasoning": F.when(
                value.isNull(), "Analysis error: no percent_change_24h"
            ).otherwise(F.concat(F.lit("24h change "), value.cast("string"), F.lit("%"))),
        }
    ).drop("_change")


def ask_model(
    df: DataFrame,
    text_col: str,
    make_client: Callable[[], TextClient],
    batch: int = CLIENT_BATCH,
) -> DataFrame:
    """Add ``reply`` and ``failure`` by calling a hosted model with ``text_col``.

    Rows pass through in their partitions; nothing is shuffled or collected.
    """
    schema = T.StructType(
        df.schema.fields
        + [
            T.StructField("reply", T.StringType()),
            T.StructField("failure", T.StringType()),
        ]
    )

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = make_client()
        for rows in batches:
            replies, failures = [], []
            texts = rows.column(text_col).to_pylist()
            for start in range(0, len(texts), batch):
                part = texts[start : start + batch]
                try:
                    answers = list(client(part))
                except Exception as error:  # the call as a whole failed
                    answers = [error] * len(part)
                for answer in answers:
                    broken = isinstance(answer, Exception)
                    replies.append(None if broken or answer is None else str(answer))
                    failures.append(str(answer) if broken else None)
            yield rows.append_column("reply", pa.array(replies, pa.string())).append_column(
                "failure", pa.array(failures, pa.string())
            )

    return df.mapInArrow(call, schema)


def score_with_model(
    df: DataFrame, prompt: Column, make_client: Callable[[], TextClient]
) -> DataFrame:
    """Score by a hosted model: failures and bad replies give a null score with the cause."""
    asked = ask_model(df.withColumn("_prompt", prompt), "_prompt", make_client)
    parsed = parse_score_reply(F.col("reply"))
    failed = F.col("failure").isNotNull()
    return asked.withColumns(
        {
            "score": F.when(~failed, parsed["score"]),
            "reasoning": F.when(
                failed, F.concat(F.lit("Analysis error: "), "failure")
            ).otherwise(parsed["reasoning"]),
        }
    ).drop("_prompt", "reply", "failure")


def hashing_embedding(
    df: DataFrame, text_col: str, output_col: str, dims: int = EMBEDDING_DIMS
) -> DataFrame:
    """Default embedder: hashed word counts of the whole text, scaled to unit length.

    No text gives no vector.
    """
    words, counts, unit = "_words", "_counts", "_unit"
    stages = [
        RegexTokenizer(inputCol="_text", outputCol=words, pattern=r"\s+"),
        HashingTF(inputCol=words, outputCol=counts, numFeatures=dims),
        Normalizer(inputCol=counts, outputCol=unit),
    ]
    prepared = df.withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
    embedded = Pipeline(stages=stages).fit(prepared).transform(prepared)
    vector = F.when(
        F.trim(F.col("_text")) != "", vector_to_array(F.col(unit), "float32")
    )
    return compute_once(embedded, {output_col: vector}).drop("_text", words, counts, unit)


def word_counts(df: DataFrame, text_col: str, dims: int = EMBEDDING_DIMS) -> DataFrame:
    """Number of words per row as the default embedder sees them."""
    tokenizer = RegexTokenizer(inputCol=text_col, outputCol="_words", pattern=r"\s+")
    return tokenizer.transform(df).withColumn("words", F.size("_words")).drop("_words")


def embed_with_model(
    df: DataFrame,
    text_col: str,
    output_col: str,
    make_client: Callable[[], Callable[[Sequence[str]], Sequence[Sequence[float] | None]]],
    batch: int = CLIENT_BATCH,
) -> DataFrame:
    """Embed by a hosted model; a failed call or missing text gives a null vector."""
    schema = T.StructType(
        df.schema.fields
        + [T.StructField(output_col, T.ArrayType(T.FloatType()))]
    )

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = make_client()
        for rows in batches:
            texts = rows.column(text_col).to_pylist()
            vectors: list = [None] * len(texts)
            present = [i for i, text in enumerate(texts) if text]
            for start in range(0, len(present), batch):
                part = present[start : start + batch]
                try:
                    answers = client([texts[i] for i in part])
                except Exception:  # the vector step never blocks a row
                    continue
                for i, answer in zip(part, answers):
                    vectors[i] = None if answer is None else [float(x) for x in answer]
            found = pa.array(vectors, pa.list_(pa.float32()))
            yield rows.append_column(output_col, found)

    return df.mapInArrow(call, schema)


# Payload fields the searchable text and the vector metadata are made of, and
# the columns they are held in. Flat columns, not a struct: Catalyst prunes
# struct fields across generators, and in a chain of them it loses some.
_TEXTS = {
    "symbol": "_symbol",
    "source": "_payload_source",
    "price_usd": "_price_text",
    "percent_change_24h": "_change_text",
    "news_headline": "_headline",
    "news_content": "_content",
}
_NUMBERS = {"price_usd": "_price", "percent_change_24h": "_change"}
_KEYS = "_keys"


def _with_fields(df: DataFrame, payload_col: str) -> DataFrame:
    """Add the payload fields as text, the numbers among them, and the keys present."""
    payload = F.col(payload_col)
    numbers = F.from_json(payload, ", ".join(f"{name} DOUBLE" for name in _NUMBERS))
    return (
        df.select("*", F.json_tuple(payload, *_TEXTS).alias(*_TEXTS.values()))
        .select("*", F.inline(F.array(numbers)).alias(*_NUMBERS.values()))
        .select("*", F.explode(F.array(F.json_object_keys(payload))).alias(_KEYS))
    )


def _with_text(fields: DataFrame, reasoning_col: str) -> DataFrame:
    """Add the searchable text of the payload fields.

    A price or change that is neither a number nor empty has no number format:
    such a row gets no text.
    """

    def unformattable(text: str, number: str) -> Column:
        given = ~F.col(text).isin("", "false")
        return F.coalesce(F.col(number).isNull() & given, F.lit(False))

    text = searchable_text(
        F.col("_symbol"),
        F.col("_price"),
        F.col("_change"),
        F.col("_headline"),
        F.col("_content"),
        F.col(reasoning_col),
    )
    usable = ~(
        unformattable("_price_text", "_price") | unformattable("_change_text", "_change")
    )
    return compute_once(fields, {"search_text": F.when(usable, text)})


_FIELD_COLUMNS = [*_TEXTS.values(), *_NUMBERS.values(), _KEYS]


def with_search_text(df: DataFrame, payload_col: str, reasoning_col: str) -> DataFrame:
    """Add the ``search_text`` of a payload and its reasoning."""
    return _with_text(_with_fields(df, payload_col), reasoning_col).drop(*_FIELD_COLUMNS)


def vectorise(
    df: DataFrame,
    embed: Callable[[DataFrame, str, str], DataFrame],
    timestamp: Column,
) -> DataFrame:
    """Add ``values`` and ``metadata`` of the vector record of each message.

    Needs payload, score and reasoning columns. A symbol or headline that is
    given but is no text, or a text that cannot be built, means neither; the
    row itself is kept.
    """

    def absent_or_text(name: str) -> Column:
        text = F.col(_TEXTS[name])
        given = F.array_contains(_KEYS, name)
        return ~given | (text.isNotNull() & string_only(F.col("payload"), name, text))

    metadata = vector_metadata(
        F.col("_symbol"),
        F.col("_payload_source"),
        F.col("score"),
        F.col("_price"),
        F.col("_change"),
        F.col("_headline"),
        F.col("reasoning"),
        timestamp,
    )
    allowed = absent_or_text("symbol") & absent_or_text("news_headline")
    prepared = _with_text(_with_fields(df, "payload"), "reasoning").withColumn(
        "search_text", F.when(allowed, F.col("search_text"))
    )
    return (
        embed(prepared, "search_text", "values")
        .withColumn("metadata", F.when(F.col("values").isNotNull(), metadata))
        .drop("search_text", *_FIELD_COLUMNS)
    )
