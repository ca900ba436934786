"""URL filters: rules first, then templates of paths judged by what the rules say of them."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.skew import salted_join
from tidemark.plans.storage import settle

ALLOW, BLOCK, NONE = "allow", "block", "none"
#: (verdict, host and path); a rule holds for its host and all below it.
RULES = (
    (ALLOW, "com/"),
    (BLOCK, "example.com/en/"),
    (ALLOW, "www.example.com/en/"),
    (BLOCK, "net/es/"),
    (BLOCK, "net/fr/"),
)
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HOST_AND_PATH = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Segments of a path that have a level of their own; what is deeper is the tail "**".
DEPTH = 8
WILD, TAIL = "*", "**"
DIGIT, EXTENSION = "[0-9]", r"\.[A-Za-z]{1,5}\z"
#: A segment keeps its name if at least one in this many visits to its node takes it,
#: so a node has no more named branches than this.
NAMED_ONE_IN = 50
#: Chance at which branches with the same distribution are told apart.
ALPHA = 0.05
#: How far apart two observed distributions may be: this times the sum of one over the
#: root of either size (a deviation bound for any number of categories).
REACH = 1 + math.sqrt(math.log(1 / ALPHA))
#: Visits added to either verdict, and the share of blocked visits that rejects.
SMOOTHING = 1
REJECT = 0.75


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z in lower case, and path; both empty without a "://"."""
    whole = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(whole, HOST_AND_PATH, 1), UPPER, UPPER.lower())
    return host, F.regexp_extract(whole, HOST_AND_PATH, 2)


def fitting_rule(rules: Sequence[tuple[str, str]], host: str = "host", path: str = "path") -> Column:
    """The longest rule that fits, or null. ``rules`` is a list read by people."""
    found = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda one: (len(one[1]), one[1])):
        domain, slash, rest = rule.partition("/")
        below = (F.col(host) == domain) | F.col(host).endswith(f".{domain}")
        fits = below & F.col(path).startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def rule_verdict(rules: Sequence[tuple[str, str]], rule: Column) -> Column:
    blocked = [name for verdict, name in rules if verdict == BLOCK]
    return F.when(rule.isin(blocked), BLOCK).when(rule.isNotNull(), ALLOW)


def _segments(path: Column) -> Column:
    parts = F.filter(F.split(path, "/"), lambda part: part != "")
    return F.when(F.size(parts) <= DEPTH, parts).otherwise(
        F.concat(F.slice(parts, 1, DEPTH), F.array(F.lit(TAIL)))
    )


def _shape(segment: Column) -> Column:
    """A segment with a digit as a wildcard with its file extension, others as they are."""
    wild = F.concat(F.lit(WILD), F.regexp_extract(segment, EXTENSION, 0))
    return F.when(segment.rlike(DIGIT), wild).otherwise(segment)


def _facts(cells: DataFrame, value: str) -> DataFrame:
    """How often each branch is seen with each ``value``."""
    counted = cells.groupBy("branch", F.col(value).alias("value")).agg(F.sum("n").alias("n"))
    return counted.withColumn("kind", F.lit(value))


def _alike(branches: DataFrame, facts: DataFrame) -> DataFrame:
    """Branches whose tails and labels are spread as in the rest of their group.

    The squared distance of two distributions is expanded into sums over the values
    a branch has itself, so no value is listed for branches that lack it.
    """
    grouped = salted_join(facts, branches.select("branch", "group", "visits", "together"), "branch", ("kind", "value"))
    same = Window.partitionBy("group", "kind", "value")
    seen = grouped.withColumn("all", F.sum("n").over(same))
    n, rest = F.col("n").cast("double"), (F.col("all") - F.col("n")).cast("double")
    whole = F.col("all").cast("double")
    sums = seen.groupBy("branch", "group", "kind", "visits", "together").agg(
        F.sum(n * n).alias("own"),
        F.sum(n * rest).alias("joint"),
        F.sum(whole * whole - rest * rest).alias("less"),
    )
    squares = (
        facts.join(branches.select("branch", "group"), "branch")
        .groupBy("group", "kind", "value")
        .agg(F.sum("n").cast("double").alias("all"))
        .groupBy("group", "kind")
        .agg(F.sum(F.col("all") * F.col("all")).alias("squares"))
    )
    v, r = F.col("visits").cast("double"), (F.col("together") - F.col("visits")).cast("double")
    others = F.col("squares") - F.col("less")
    distance = F.col("own") / (v * v) + others / (r * r) - 2 * F.col("joint") / (v * r)
    reach = F.lit(REACH) * (1 / F.sqrt(v) + 1 / F.sqrt(r))
    judged = sums.where("together > visits").join(squares, ["group", "kind"])
    near = judged.groupBy("branch").agg(F.min(distance <= reach * reach).alias("alike"))
    return near.where("alike").select("branch")


def _branch_names(active: DataFrame) -> DataFrame:
    """(branch, named): the name each kept segment has in templates.

    A segment keeps its name if enough visits of its node take it. Kept branches of
    a node with the same usual tail and the same usual label form a group; those
    whose tails and labels are spread as in the rest of the group are merged.
    """
    cells = settle(
        active.groupBy("host", "template", "name", "tail", "label").agg(F.count("*").alias("n")),
        "branches",
    ).select(
        F.struct("host", "template").alias("node"),
        F.struct("host", "template", "name").alias("branch"),
        "name",
        "tail",
        "label",
        "n",
    )
    totals = cells.groupBy("node").agg(F.sum("n").alias("total"))
    visits = cells.where("name IS NOT NULL").groupBy("node", "branch").agg(F.sum("n").alias("visits"))
    kept = salted_join(visits, totals, "node", ("branch",)).where(f"visits * {NAMED_ONE_IN} >= total")
    kept = settle(kept.drop("total"), "named")
    own = salted_join(cells.drop("node"), kept.select("branch"), "branch", ("tail", "label"))
    facts = settle(_facts(own, "tail").unionByName(_facts(own, "label")), "facts")
    usual = [
        facts.where(F.col("kind") == kind)
        .groupBy("branch")
        .agg(F.max_by("value", F.struct("n", "value")).alias(f"usual_{kind}"))
        for kind in ("tail", "label")
    ]
    grouped = kept.join(usual[0], "branch").join(usual[1], "branch")
    group = F.struct("node", "usual_tail", "usual_label")
    inside = Window.partitionBy("group")
    branches = settle(
        grouped.select("branch", "visits", group.alias("group")).withColumn(
            "together", F.sum("visits").over(inside)
        ),
        "groups",
    )
    alike = _alike(branches, facts).withColumn("alike", F.lit(True))
    # A group has NAMED_ONE_IN branches at most, so its names are few.
    names = F.sort_array(F.collect_set(F.when(F.col("alike"), F.col("branch.name"))).over(inside))
    merged = F.col("alike") & (F.size("names") > 1)
    joined = F.concat(F.lit("("), F.array_join("names", "|"), F.lit(")"))
    return (
        branches.join(alike, "branch", "left")
        .withColumn("names", names)
        .select("branch", F.when(merged, joined).otherwise(F.col("branch.name")).alias("named"))
    )


def templates(urls: DataFrame) -> DataFrame:
    """``urls`` (host, path, label and more) with the ``template`` of every path.

    Level by level, from the host down: segments with digits and those that few
    visits take become wildcards, similar branches become one. All figures are sums
    combined inside the tasks, so a host may hold any share of the rows.
    """
    segments = urls.withColumn("_segments", _segments(F.col("path")))
    rows = segments.withColumn("_shapes", F.transform("_segments", _shape))
    rows = settle(rows.withColumn("template", F.lit("")), "urls")
    deepest = rows.agg(F.max(F.size("_segments"))).first()[0] or 0
    for level in range(deepest):
        segment, shape = F.get("_segments", F.lit(level)), F.get("_shapes", F.lit(level))
        name = F.when(segment == shape, segment)
        active = rows.where(F.size("_segments") > level).select(
            "host",
            "template",
            name.alias("name"),
            F.concat_ws("/", F.slice("_shapes", level + 2, DEPTH + 1)).alias("tail"),
            F.coalesce("label", F.lit(NONE)).alias("label"),
        )
        branch = F.struct("host", "template", name.alias("name"))
        taken = salted_join(
            rows.withColumn("branch", branch), _branch_names(active), "branch", ("path",), "left"
        )
        step = F.coalesce("named", F.when(segment == shape, F.lit(WILD)).otherwise(shape))
        grown = F.when(F.size("_segments") > level, F.concat_ws("/", "template", step))
        rows = taken.withColumn("template", F.coalesce(grown, "template")).drop("branch", "named")
        rows = settle(rows, "urls")
    return rows.drop("_segments", "_shapes")


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    id_column: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """Every page with host, path, rule, template, purity and verdict.

    The longest fitting rule decides. Pages without one follow the template of their
    host they belong to: ``purity`` is the smoothed share of blocked visits among
    those of the template that a rule decides, and from ``REJECT`` on it is blocked.
    A template no rule has touched is allowed.

    A null url, or one without "://", has an empty host and path and is a page of
    the empty host. Ids may be null or repeated; every row is judged, equal urls
    alike. Paths of any length are read whole; segments beyond ``DEPTH`` share one
    tail. An empty table gives an empty result. Only the two named columns are read.
    """
    host, path = host_and_path(F.col(url))
    split = pages.select(F.col(id_column).alias("id"), host.alias("host"), path.alias("path"))
    ruled = split.withColumn("rule", fitting_rule(rules))
    rows = templates(ruled.withColumn("label", rule_verdict(rules, F.col("rule"))))
    rows = rows.withColumn("node", F.struct("host", "template"))
    blocked = F.count(F.when(F.col("label") == BLOCK, 1))
    purity = (blocked + SMOOTHING) / (F.count("label") + 2 * SMOOTHING)
    shares = rows.groupBy("node").agg(purity.alias("purity"))
    learnt = F.when(F.col("purity") >= REJECT, BLOCK).otherwise(ALLOW)
    return salted_join(rows, shares, "node", ("path",)).select(
        F.col("id").alias(id_column),
        "host",
        "path",
        "rule",
        F.coalesce("label", learnt).alias("verdict"),
        "template",
        "purity",
    )
