"""Quality rules kept as a ledger of failure bits and measurements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.once import compute_once

SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 3

MEASURES = (
    "n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words n_upper".split()
)


#: What fails each rule, as an expression over the measurements.
RULES = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "word_chars < 3 * n_words OR word_chars > 10 * n_words",
    "capitals": "10 * n_upper > 3 * word_chars",
}
#: Bit of every rule. A bit is never given to another rule, so ledgers stay readable.
BITS = {name: 1 << i for i, name in enumerate(RULES)}
#: A policy is the set of rules whose failure rejects a document.
POLICIES = {
    "base": BITS["few_words"] | BITS["repeated_windows"],
    "v1": sum(BITS.values()),
}


def measured(docs: DataFrame, text: Column, keep: Column) -> DataFrame:
    """``keep`` and the measurements of ``text``, one row per row.

    Every step is an expression inside the row: words are hashed by windows of
    three, windows that may repeat are found by sorting 31 bits of their hash,
    and only those are compared by all 64 bits.
    """
    filled = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split("t", "\n"), lambda line: line.rlike(NOT_SPACE))
    base = docs.select(keep.alias("keep"), filled.alias("t")).select(
        "keep", "t", F.array_remove(F.split("t", SPACE), "").alias("words"), lines.alias("lines")
    )
    last = F.size("words") - WINDOW
    windows = F.when(
        last >= 0,
        F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    counted = base.select(
        "keep",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.regexp_count("t", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        windows.alias("w"),
    )
    low = F.lit(0x7FFFFFFF).cast("long")
    packed = F.when(
        F.size("w") > F.size(F.array_distinct("w")),
        F.sort_array(
            F.transform(
                "w", lambda x, i: F.shiftleft(x.bitwiseAND(low), 32).bitwiseOR(i.cast("long"))
            )
        ),
    )
    counted = counted.withColumn("s", packed)

    def beside(items: str, i: Column, part) -> Column:
        here, before, after = (part(F.get(items, i + d)) for d in (0, -1, 1))
        return F.coalesce(here == before, F.lit(False)) | F.coalesce(here == after, F.lit(False))

    likely = F.transform(
        F.filter("s", lambda x, i: beside("s", i, lambda y: F.shiftright(y, 32))),
        lambda x: x.bitwiseAND(low).cast("int"),
    )
    exact = F.array_sort(
        F.transform("likely", lambda i: F.struct(F.get("w", i).alias("h"), i.alias("i")))
    )
    found = F.filter("pairs", lambda x, i: beside("pairs", i, lambda y: y["h"]))
    covered = F.array_distinct(
        F.flatten(
            F.transform("found", lambda x: F.array(*[x["i"] + k for k in range(WINDOW)]))
        )
    )
    return (
        counted.withColumn("likely", likely)
        .withColumn("pairs", exact)
        .withColumn("found", found)
        .select(
            "keep",
            *[m for m in MEASURES if m != "n_repeat_words"],
            F.when(F.size("found") > 0, F.size(covered))
            .otherwise(0)
            .cast("long")
            .alias("n_repeat_words"),
        )
    )


def failure_bits() -> Column:
    """The rules a row of measurements fails, as one number."""
    bits = F.lit(0)
    for name, fails in RULES.items():
        bits = bits.bitwiseOR(F.when(F.expr(fails), BITS[name]).otherwise(0))
    return bits


def rejected(policy: str, bits: str = "failed") -> Column:
    return F.col(bits).bitwiseAND(F.lit(POLICIES[policy])) != 0


def ledger(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Every rule evaluated once per document.

    ``failed`` holds a bit per rule (``BITS``) beside the measurements the rules
    read. Policies are applied to it later (``rejected``) without the texts.

    A null text has no words, like an empty one; ``\\n`` alone splits lines, and
    a line without a word counts neither as a line nor as a repeated one. Rows
    are judged one by one: a null or repeated id changes nothing, and an empty
    table gives an empty ledger. Only the two named columns are read.
    """
    rows = measured(docs, F.col(text), F.col(doc))
    return rows.select(F.col("keep").alias("doc_id"), *MEASURES, failure_bits().alias("failed"))


def apply_policy(docs: DataFrame, policy: str = "v1", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that a policy keeps, with all their columns, whatever their names.

    Rows are kept or rejected by their text alone, as in ``ledger``.
    """
    rows = measured(docs, F.col(text), F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    kept = compute_once(rows, {"failed": failure_bits()}).where(~rejected(policy))
    return kept.select("keep.*")


def ablations(rows: DataFrame, policy: str = "v1", bits: str = "failed") -> DataFrame:
    """What every rule of a policy rejects, and what would be kept without it.

    One row per rule: ``n_failed`` documents fail it, ``n_only`` fail no other
    rule of the policy. Documents are first counted by their bits (at most one
    row per combination and task), then the few combinations are read per rule.
    """
    mask = F.lit(POLICIES[policy])
    combos = (
        rows.groupBy(F.col(bits).bitwiseAND(mask).alias("failed")).agg(F.count("*").alias("n"))
    )
    rules = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("rule"), F.lit(bit).alias("bit"))
                for name, bit in BITS.items()
                if POLICIES[policy] & bit
            ]
        )
    )
    each = combos.select("*", rules.alias("r")).select("failed", "n", "r.*")
    hit = F.col("failed").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule", "bit").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("failed") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
        F.sum("n").alias("n_documents"),
    )
