"""Anchoring summaries to the roots of the taxonomy."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.text import batch_number, extract_tag
from threadloom.lineage import cut
from threadloom.operators.models import map_model
from threadloom.operators.skew import broadcast_if_small

# Root ids, the catch-all root, the answer tag, the default topic.
ROOTS = ["ROOT A", "ROOT B", "ROOT C", "ROOT D", "ROOT E", "ROOT F", "ROOT G", "ROOT X"]
OTHER_ROOT = "ROOT X"
ROOT_TAG = "classification"
DEFAULT_TOPIC = "General_Discourse"

BATCH_SUMMARIES = 500  # summaries handed to one induction call


def root_from_answer(answer: Column) -> Column:
    """Root id named in a model answer; anything else is the catch-all."""
    named = extract_tag(answer, ROOT_TAG)
    return F.when(named.isin(*ROOTS), named).otherwise(F.lit(OTHER_ROOT))


def route_by_model(summaries: DataFrame, fn: Callable[[dict], str]) -> DataFrame:
    """Root per summary from a model; a failed call routes to the catch-all."""
    carried = [c for c in summaries.columns if c != "root"]
    answers = map_model(summaries, fn, carried, "string")
    return answers.select(*carried, root_from_answer(F.col("result")).alias("root"))


def route_by_lexicon(summaries: DataFrame, lexicon: list[tuple[str, str]]) -> DataFrame:
    """Root whose keywords appear most often as distinct, case-insensitive matches.

    Ties go to the root named first in the lexicon; an empty lexicon gives the
    catch-all. The lexicon is configuration:
    it becomes an expression, so routing needs neither join nor shuffle.
    """
    by_root: dict[str, list[str]] = {}
    for root, keyword in lexicon:
        by_root.setdefault(root, []).append(keyword.lower())
    if not by_root:
        return summaries.withColumn("root", F.lit(OTHER_ROOT))
    text = F.col("_text")

    def hits(words: list[str]) -> Column:
        listed = F.array(*[F.lit(w) for w in dict.fromkeys(words)])
        return F.size(F.filter(listed, lambda w: F.contains(text, w)))

    scored = F.array(*[
        F.struct(hits(words).alias("n"), F.lit(-i).alias("pos"), F.lit(root).alias("root"))
        for i, (root, words) in enumerate(by_root.items())
    ])
    best = F.array_max(scored)
    return (
        summaries.withColumn("_text", F.lower("summary"))
        .withColumn("_best", best)
        .withColumn("root", F.when(F.col("_best.n") > 0, F.col("_best.root")).otherwise(OTHER_ROOT))
        .drop("_text", "_best")
    )


def group_by_root(anchored: DataFrame, batch: int = BATCH_SUMMARIES) -> DataFrame:
    """Summaries of each root as arrays, in batches of about ``batch``.

    A root with few summaries is one batch. Large roots are split, so no task
    and no model call ever holds a whole root.
    """
    sizes = anchored.groupBy("root").agg(
        F.ceil(F.count("*") / batch).cast("bigint").alias("batch_count")
    )
    sizes = broadcast_if_small(cut(sizes, "root-sizes"))
    item = F.struct("thread_id", "summary")
    return (
        anchored.join(sizes, "root")
        .withColumn("batch_no", batch_number("thread_id", F.col("batch_count")))
        .groupBy("root", "batch_no")
        .agg(F.sort_array(F.collect_list(item)).alias("_items"))
        .select(
            F.col("root").alias("root_id"),
            "batch_no",
            F.transform("_items", lambda x: x["summary"]).alias("summaries"),
        )
    )
