"""Evaluating a costly expression once, however often its value is used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns whose expressions are not repeated where they are used.

    Catalyst copies a projected expression into every filter and projection
    above it, so a parse or a feature transform used five times runs five
    times. A generator over a one-element array yields the same row and stops
    the copying; it is narrow and costs nothing else.
    """
    values = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(values)))
