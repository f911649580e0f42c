"""URL filter by a path-template tree.

Every host has a tree of path templates. A segment that is rare among its
siblings, in count and share, and labelled as they are becomes a typed wildcard; templates that differ in their last literal
only are merged where their labels do not differ by more than chance; and a
template is rejected by its smoothed share of blocked pages. Pages that a rule
decides are the labelled ones. Everything is plain DataFrame work.

Defined cases: a NULL url, or one without ``://``, has an empty host and path
and is judged like any other template. Repeated pages count repeatedly and keep
their rows. An empty table gives no rows. Columns other than the id and the url
are not read, so their names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host with all its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self) -> Column:
        host = F.col("host")
        return ((host == self.host) | host.endswith("." + self.host)) & F.col("path").startswith(self.path)


@dataclass(frozen=True)
class TreeParams:
    """``depth``: segments beyond it are one tail. A segment stays literal if it
    holds at least ``1 / share`` of the pages at its place, or ``support`` pages, or
    if its labels differ from those of its siblings by more than chance. ``chance``:
    squared Hoeffding factor, ln(2 / 0.05) / 2 by default. ``weight``: pages that the
    prior counts for. Templates above ``limit`` are blocked."""

    depth: int = 8
    share: int = 20
    support: int = 100
    chance: float = 1.8444397270569681
    weight: float = 10.0
    limit: float = 0.5


def parse_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def apply_rules(rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; NULL if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        name = F.when(rule.fits(), rule.name).otherwise(name)
        verdict = F.when(rule.fits(), rule.verdict).otherwise(verdict)
    return name, verdict


def _segments(depth: int) -> Column:
    parts = F.split(F.regexp_replace("path", "^/", ""), "/")
    return F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(
        F.when(
            F.size(parts) > depth,
            F.concat(F.slice(parts, 1, depth), F.array(F.lit("**"))),
        ).otherwise(parts)
    )


def _kind(segment: Column) -> Column:
    """Wildcard of a segment: digits are one sign, other text is kept by type only."""
    return (
        F.when(segment.isin("", "**"), segment)
        .when(segment.rlike("^[0-9]+$"), F.lit("{n}"))
        .when(segment.rlike("^[0-9]+[.][a-z]{1,5}$"), F.concat(F.lit("{n}"), F.regexp_extract(segment, "[.][a-z]+$", 0)))
        .when(segment.rlike("[0-9]"), F.lit("{m}"))
        .otherwise(F.lit("{w}"))
    )


def _places(segments: Column, kinds: Column) -> Column:
    """``kind path > segment`` of every segment: its place in the tree and its value."""
    return F.transform(
        segments,
        lambda s, i: F.concat(F.array_join(F.slice(kinds, F.lit(1), i), "/"), F.lit(">"), s),
    )


def judge_urls(
    pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url",
    params: TreeParams | None = None,
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, template, block_share.

    The work between the two joins is on aggregates per host, so a host with a
    third of all pages only makes the joins uneven, which adaptive execution
    splits (both are plain outer joins below a projection).
    """
    p = params or TreeParams()
    host, path = parse_url(F.col(url_col))
    parsed = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    name, verdict = apply_rules(rules)
    parsed = parsed.select(
        id_col, "host", "path", name.alias("rule"), verdict.alias("known"), _segments(p.depth).alias("segments")
    ).withColumn("kinds", F.transform("segments", _kind))
    parsed = parsed.withColumn("places", _places(F.col("segments"), F.col("kinds")))

    # Segments with enough pages at their place, or with labels of their own, stay literal. They are joined as rows.
    paths = parsed.groupBy("host", "path").agg(
        F.count("*").alias("pages"), F.count("known").alias("n"), F.count(F.when(F.col("known") == "block", 1)).alias("b"),
        F.first("places").alias("places"),
    )
    at_places = paths.select("host", "path", "pages", "n", "b", F.posexplode("places").alias("i", "place"))
    counts = at_places.groupBy("host", "place").agg(F.sum("pages").alias("pages"), F.sum("n").alias("n"), F.sum("b").alias("b"))
    counts = counts.withColumn("node", F.regexp_extract("place", "^([^>]*)>", 1))
    totals = counts.groupBy("host", "node").agg(F.sum("pages").alias("all_pages"), F.sum("n").alias("all_n"), F.sum("b").alias("all_b"))

    def apart(some: str, of: str) -> Column:
        """Hoeffding test of a segment's share against that of its siblings."""
        n, rest = F.nullif(F.col(of), F.lit(0)), F.nullif(F.col(f"all_{of}") - F.col(of), F.lit(0))
        gap = F.col(some) / n - (F.col(f"all_{some}") - F.col(some)) / rest
        return F.coalesce(gap * gap > F.lit(p.chance) * (1.0 / n + 1.0 / rest), F.lit(False))

    # Blocked ones of the ruled pages, and ruled and blocked ones of all: siblings without a rule are no siblings of blocked pages.
    differs = apart("b", "n") | apart("n", "pages") | apart("b", "pages")
    literals = (
        counts.join(totals, ["host", "node"])
        .filter((F.col("pages") * p.share >= F.col("all_pages")) | (F.col("pages") >= p.support) | differs)
        .select("host", "place")
    )
    named = ~F.regexp_extract("place", "^[^>]*>(.*)$", 1).rlike("[0-9]")
    kept = (
        at_places.filter(named).select("host", "path", "i", "place").join(literals.filter(named), ["host", "place"])
        .groupBy("host", "path").agg(F.collect_set("i").alias("literals"))
    )
    template = F.concat(
        F.lit("/"),
        F.array_join(
            F.transform(
                "segments", lambda s, i: F.when(F.array_contains("literals", i), s).otherwise(F.element_at("kinds", i + 1))
            ),
            "/",
        ),
    )
    placed = parsed.join(kept, ["host", "path"], "left").select(
        id_col, "host", "path", "rule", "known", F.when(F.col("path") == "", F.lit("")).otherwise(template).alias("template"),
    )
    judged = _judge_templates(placed, p)
    return placed.join(judged, ["host", "template"], "left").select(
        id_col, "host", "path", "rule", F.coalesce("known", "judged").alias("verdict"), "template", "block_share"
    )


def _judge_templates(placed: DataFrame, p: TreeParams) -> DataFrame:
    """(host, template, judged, block_share) from the labelled pages."""
    leaves = placed.groupBy("host", "template").agg(
        F.count("known").alias("n"), F.count(F.when(F.col("known") == "block", 1)).alias("b")
    )
    # The parent has a wildcard in place of the last literal segment.
    leaves = leaves.withColumn("parent", F.regexp_replace("template", r"/[^/{}*]+((?:/(?:[{][^/]*|[*]*))*)$", "/*$1"))
    pools = leaves.groupBy("host", "parent").agg(F.sum("n").alias("pool_n"), F.sum("b").alias("pool_b"))
    n, pool_n = F.nullif(F.col("n"), F.lit(0)), F.nullif(F.col("pool_n"), F.lit(0))
    gap = F.col("b") / n - F.col("pool_b") / pool_n
    # Squared, and without a square root, so that every engine decides alike.
    similar = (F.col("n") > 0) & (gap * gap <= F.lit(p.chance) * (1.0 / n + 1.0 / pool_n))
    branches = leaves.join(pools, ["host", "parent"]).withColumn("branch", F.when(similar, F.col("parent")).otherwise(F.col("template")))
    merged = branches.groupBy("host", "branch").agg(F.sum("n").alias("branch_n"), F.sum("b").alias("branch_b"))

    # Smoothing: a template leans on the same template of all hosts, and that on an even chance.
    shared = leaves.groupBy("template").agg(F.sum("n").alias("all_n"), F.sum("b").alias("all_b")).select(
        "template", ((F.col("all_b") + p.weight * 0.5) / (F.col("all_n") + p.weight)).alias("prior")
    )
    share = (F.col("branch_b") + p.weight * F.col("prior")) / (F.col("branch_n") + p.weight)
    return (
        branches.join(merged, ["host", "branch"]).join(shared, "template")
        .select("host", "template", share.alias("raw"))
        .select(
            "host", "template", F.round("raw", 6).alias("block_share"),
            F.when(F.round("raw", 6) > p.limit, "block").otherwise("allow").alias("judged"),
        )
    )
