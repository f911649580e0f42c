"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from threadloom.lineage import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are tied to its smallest neighbour (or itself)."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(id, label) for every node of (a, b): label is the smallest id of its component.

    Each round is one written table of at most one row per edge. Sums are made
    before the shuffle and the joins are plain inner joins, so a node with very
    many edges is split by adaptive execution. No edges: no rows.
    """
    def round_of(df: DataFrame) -> tuple[DataFrame, tuple]:
        seen = Observation()
        mark = F.xxhash64("a", "b")
        stored = cut(
            df.filter("a <> b").distinct(), "components", seen, F.count("*").alias("n"),
            F.sum(mark.cast("decimal(38,0)")).alias("s"),
        )
        return stored, (seen.get["n"], seen.get["s"])

    current, state = round_of(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    while True:
        current, after = round_of(_small_star(_large_star(current)))
        if after == state:
            break
        state = after
    leaves = current.select(F.col("a").alias("id"), F.col("b").alias("label"))
    return leaves.union(current.select(F.col("b").alias("id"), F.col("b").alias("label")).distinct())
