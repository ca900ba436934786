"""Reading scalar fields out of JSON payloads.

``json_tuple`` parses a document once for all wanted fields; one
``get_json_object`` per field would parse it again each time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.once import compute_once


def is_json_object(document: Column) -> Column:
    """True for a JSON object; false for other JSON and for text that is no JSON."""
    return F.json_object_keys(document).isNotNull()


def has_key(document: Column, key: str) -> Column:
    """True when the object holds the key, even with an explicit null."""
    return F.coalesce(
        F.array_contains(F.json_object_keys(document), key), F.lit(False)
    )


def value_kind(document: Column, key: str) -> Column:
    """Kind of the value under ``key`` (STRING, DECIMAL(..), OBJECT<..>, VOID); null if absent."""
    return F.schema_of_variant(
        F.try_variant_get(F.try_parse_json(document), f"$.{key}", "variant")
    )


def _opens_container(text: Column) -> Column:
    return text.startswith("{") | text.startswith("[")


def scalar_only(document: Column, key: str, text: Column) -> Column:
    """``text`` as extracted for ``key``, but null where the value is an object or array.

    Only text that opens like a container is looked at again, so the second
    parse is paid on suspicious rows alone.
    """
    kind = value_kind(document, key)
    return F.when(~_opens_container(text), text).when(
        ~kind.rlike("^(OBJECT|ARRAY)"), text
    )


def string_only(document: Column, key: str, text: Column) -> Column:
    """True unless the value extracted as ``text`` is a number, boolean, object or array.

    Again only text that could be one of these is looked at twice.
    """
    could_be_other = (
        F.substring(text, 1, 1).isin(*"-0123456789")
        | text.isin("true", "false")
        | _opens_container(text)
    )
    return F.when(could_be_other, value_kind(document, key) == "STRING").otherwise(
        F.lit(True)
    )


def extract_scalars(df: DataFrame, document: str, keys: Sequence[str]) -> DataFrame:
    """Add one text column per key, all from a single parse of ``document``."""
    drawn = [f"__{key}" for key in keys]
    tupled = df.select("*", F.json_tuple(document, *keys).alias(*drawn))
    doc = F.col(document)
    guarded = {key: scalar_only(doc, key, F.col(raw)) for key, raw in zip(keys, drawn)}
    return compute_once(tupled, guarded).drop(*drawn)
