"""Knowledge graph as two tables: entities(name) and edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.functions.text import has_content, relation_name, strip
from threadloom.operators.messages import dedupe

EDGE_KEY = ["subject", "predicate", "object"]
EDGE = [*EDGE_KEY, "thread_id", "topic", "context"]


def clean_triplets(triplets: DataFrame) -> DataFrame:
    """Stripped fields, relation-style predicates; incomplete triplets are skipped."""
    whole = has_content(F.col("subject")) & has_content(F.col("predicate")) & has_content(F.col("object"))
    return triplets.filter(whole).select(
        "seq", "thread_id", "topic",
        strip(F.col("subject")).alias("subject"),
        relation_name(strip(F.col("predicate"))).alias("predicate"),
        strip(F.col("object")).alias("object"),
        F.coalesce(strip(F.col("context")), F.lit("")).alias("context"),
    )


def edges(triplets: DataFrame) -> DataFrame:
    """One edge per (subject, predicate, object); the largest ``seq`` sets its properties."""
    latest = [F.desc("seq"), *[F.col(c).asc_nulls_last() for c in ("thread_id", "topic", "context")]]
    return dedupe(clean_triplets(triplets), EDGE_KEY, latest).select(*EDGE)


def entities(edge_table: DataFrame) -> DataFrame:
    """Distinct end points of the edges."""
    ends = F.explode(F.array("subject", "object")).alias("name")
    return edge_table.select(ends).distinct()


def build_graph(triplets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entities, edges)."""
    e = edges(triplets)
    return entities(e), e


def merge_edges(stored: DataFrame, triplets: DataFrame) -> DataFrame:
    """Stored edges with new triplets merged in; new properties win."""
    new = edges(triplets)
    return stored.select(*EDGE).join(new.select(*EDGE_KEY), EDGE_KEY, "left_anti").unionByName(new)


def triplets_by_threads(edge_table: DataFrame, threads: DataFrame) -> DataFrame:
    """Edges of the given threads (first column), predicates in lower case."""
    wanted = threads.select(F.col(threads.columns[0]).alias("thread_id")).distinct()
    return edge_table.join(wanted, "thread_id", "left_semi").select(
        "subject", F.lower("predicate").alias("predicate"), "object", "context", "thread_id"
    )
