"""Numeric column helpers: safe casts, stable rounding, score bounds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The score range and the neutral score used when one is missing.
SCORE_MIN = 1.0
SCORE_MAX = 10.0
SCORE_NEUTRAL = 5.0

# What a text may look like to count as a floating-point number. Spark's own
# cast also takes Java suffixes such as "1.0d", which a warehouse cast refuses.
_FLOAT_TEXT = (
    r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"
)


def snap(value: Column) -> Column:
    """Value as a 9-digit decimal.

    Summation order moves a double average by about 1e-16 from run to run; at
    nine digits that noise is gone, so rounding and thresholds are repeatable.
    """
    return value.try_cast("decimal(38,9)")


def snap_round(value: Column, digits: int) -> Column:
    """Round half away from zero, repeatably. NaN and huge values round as doubles."""
    return F.coalesce(
        F.round(snap(value), digits).cast("double"), F.round(value, digits)
    )


def safe_double(text: Column) -> Column:
    """Text to double, null where the text is not a number.

    The pattern is tried only on text with a letter that a Java suffix or hex
    digits would need; any other text is left to the cast.
    """
    odd = text.rlike("[dDfFxX]")
    return F.when(~odd | text.rlike(_FLOAT_TEXT), text.try_cast("double"))


def clamp_score(score: Column) -> Column:
    """Keep a score within the allowed range; a missing score stays missing."""
    return F.when(
        score.isNotNull(),
        F.greatest(F.lit(SCORE_MIN), F.least(F.lit(SCORE_MAX), score)),
    )
