"""Multi-party dialogues rendered once from the view of every participant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.pieces import running_sum

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Speakers that set the scene and are never played by the model.
NARRATORS = ("system",)
UNKNOWN = "unknown"


def escaped(text: Column) -> Column:
    """Text that cannot open or close a message itself; null counts as empty."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|im_"), F.lit("<| im_"))


def named(speaker: Column) -> Column:
    """A speaker's name that stays within the first line of a message."""
    return F.regexp_replace(escaped(speaker), r"[\n\x0B\f\r\u0085\u2028\u2029]+", " ")


def rotate(
    turns: DataFrame,
    conv: str = "conv_id",
    order: str = "turn",
    speaker: str = "role",
    text: str = "text",
    narrators: Sequence[str] = NARRATORS,
) -> DataFrame:
    """Every dialogue rendered once for each of its participants.

    One row per dialogue, perspective and message: the message as it stands in
    that rendering (``rendered``), its part (``assistant`` for the perspective's
    own messages, ``user`` with the speaker's name for the others, ``system``
    for narrators), where it stands in the whole dialogue (``char_start`` to
    ``char_end``, code points) and which of these characters are trained on
    (``mask_start`` to ``mask_end``: the answer and its closing mark; null for
    messages of others). Concatenating ``rendered`` by ``char_start`` gives the
    dialogue.

    A dialogue may be of any length: messages stay rows, are dealt out by range
    and get their place from sums per piece, so that no task holds a dialogue.

    Rows without a dialogue id belong to no dialogue and are left out. Messages
    without a turn come first; ties are ordered by speaker and text, and repeated
    rows are repeated messages. A null or blank speaker is the user ``unknown``,
    from whose view nothing is rendered, so a dialogue in which nobody else but
    narrators speaks gives no rows. Null texts are empty messages. Marks in texts
    and names, and line breaks in names, are rendered so that they open or close nothing;
    ``speaker`` and ``perspective`` keep the name as it is. An empty table gives an
    empty result; further columns are not read.
    """
    name = F.trim(F.coalesce(F.col(speaker).cast("string"), F.lit("")))
    said = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).alias("conv_id"),
        F.col(order).cast("long").alias("turn"),
        F.when(name == "", UNKNOWN).otherwise(name).alias("speaker"),
        escaped(F.col(text)).alias("content"),
    )
    outside = [*narrators, UNKNOWN]
    views = (
        said.where(~F.col("speaker").isin(outside))
        .select("conv_id", F.col("speaker").alias("perspective"))
        .distinct()
    )
    own = F.col("speaker") == F.col("perspective")
    part = (
        F.when(own, "assistant")
        .when(F.col("speaker").isin(list(narrators)), "system")
        .otherwise("user")
    )
    head = F.concat(
        F.lit(OPEN),
        F.col("part"),
        F.when(F.col("part") == "user", F.concat(F.lit(" name="), named(F.col("speaker")))).otherwise(""),
        F.lit("\n"),
    )
    cast = (
        said.join(views, "conv_id")
        .withColumn("part", part)
        .select(
            "conv_id",
            "perspective",
            "turn",
            "speaker",
            "part",
            F.concat(head, "content", F.lit(CLOSE + "\n")).alias("rendered"),
            F.char_length(head).cast("long").alias("head_chars"),
        )
        .withColumn("chars", F.char_length("rendered").cast("long"))
    )
    placed = running_sum(
        cast, "chars", ["turn", "speaker", "rendered"], by=["conv_id", "perspective"]
    )
    start = F.col("running") - F.col("chars")
    trained = F.col("part") == "assistant"
    return placed.select(
        "conv_id",
        "perspective",
        "turn",
        "speaker",
        "part",
        "rendered",
        start.alias("char_start"),
        F.col("running").alias("char_end"),
        F.when(trained, start + F.col("head_chars")).alias("mask_start"),
        F.when(trained, F.col("running") - 1).alias("mask_end"),
    )
