"""Two-level taxonomies per root, as a long table (root_id, domain, topic)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.lineage import cut
from threadloom.operators.models import failed, map_model, succeeded
from threadloom.operators.routing import BATCH_SUMMARIES, group_by_root
from threadloom.operators.skew import broadcast_if_small
from threadloom.schemas import TAXONOMY_UPDATE

FAN_IN = 16  # answers of one combining call


def merge_taxonomy(current: DataFrame, updated: DataFrame) -> DataFrame:
    """Roots in ``updated`` replace the same roots of ``current`` as a whole."""
    kept = current.join(updated.select("root_id").distinct(), "root_id", "left_anti")
    return kept.unionByName(updated)


def with_current_tree(batches: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Attach each root's tree as an array of (domain, topics), [] when it has none."""
    domains = taxonomy.groupBy("root_id", "domain").agg(
        F.sort_array(F.collect_set("topic")).alias("topics")
    )
    trees = domains.groupBy("root_id").agg(
        F.sort_array(F.collect_list(F.struct("domain", "topics"))).alias("current_tree")
    )
    # Few roots, many batches per root: a shuffle join would gather a root's batches.
    trees = broadcast_if_small(cut(trees, "current-trees"))
    empty = F.array().cast(TAXONOMY_UPDATE)
    return batches.join(trees, "root_id", "left").withColumn(
        "current_tree", F.coalesce("current_tree", empty)
    )


def taxonomy_rows(answers: DataFrame) -> DataFrame:
    """Answers (``result``: array of domain and topics, in the order of ``batch_no``) → long table.

    A domain that a root's answers name twice keeps its last topics.
    """
    each = answers.select("root_id", "batch_no", F.posexplode("result").alias("pos", "d"))
    named = each.select("root_id", F.col("d.domain").alias("domain"), F.struct("batch_no", "pos", "d.topics").alias("at"))
    last = named.groupBy("root_id", "domain").agg(F.max_by("at", F.struct("at.batch_no", "at.pos")).alias("at"))
    return last.select("root_id", "domain", F.explode_outer("at.topics").alias("topic")).distinct()


def induce_taxonomy(
    anchored: DataFrame,
    taxonomy: DataFrame,
    fn: Callable[[dict], list[dict]],
    batch: int = BATCH_SUMMARIES,
    combine: Callable[[dict], list[dict]] | None = None,
    fan_in: int = FAN_IN,
) -> tuple[DataFrame, DataFrame]:
    """New taxonomy and failed calls.

    ``fn`` gets ``root_id``, ``batch_no``, ``summaries`` and ``current_tree`` and returns
    domains with topics. Without ``combine`` the answers of a root's batches, in batch
    order, are joined end to end. With it they are reduced as a tree: ``combine`` gets
    ``root_id``, ``partials`` (at most ``fan_in`` answers in order), ``current_tree`` and
    ``is_last``, level by level until one answer is left, for roots of one batch too. The
    current tree then enters once, with the last call; all other calls get an empty one.
    In either case a domain named twice keeps its last topics. A root is replaced only
    if all its calls succeed; otherwise it keeps its tree and its failed calls are
    listed (``combine`` as batch -1, -2, … by level).
    """
    batches = group_by_root(anchored, batch)
    if combine is None:
        batches = with_current_tree(batches, taxonomy)
    else:
        batches = batches.withColumn("current_tree", F.array().cast(TAXONOMY_UPDATE))
    results = map_model(batches, fn, ["root_id", "batch_no"], TAXONOMY_UPDATE)
    lost = failed(results)
    whole = succeeded(results).join(lost.select("root_id").distinct(), "root_id", "left_anti")
    if combine is None:
        return merge_roots(taxonomy, whole), lost
    answers, more = _reduce(whole, taxonomy, combine, fan_in)
    # An empty answer still replaces its root.
    return merge_roots(taxonomy, answers), lost.unionByName(more)


def _reduce(
    answers: DataFrame, taxonomy: DataFrame, combine: Callable[[dict], list[dict]], fan_in: int
) -> tuple[DataFrame, DataFrame]:
    """One answer per root from (root_id, batch_no, result), and the failed calls."""
    spans = answers.groupBy("root_id").agg((F.max("batch_no") + 1).alias("span"))
    nodes, level, done, lost = cut(answers.join(spans, "root_id"), "partial-answers"), 0, [], []
    while not nodes.isEmpty():
        level += 1
        groups = nodes.groupBy("root_id", "span", F.floor(F.col("batch_no") / fan_in).alias("batch_no")).agg(
            F.sort_array(F.collect_list(F.struct("batch_no", "result"))).alias("_p")
        )
        groups = groups.select(
            "root_id", "batch_no", F.ceil(F.col("span") / fan_in).alias("span"), (F.col("span") <= fan_in).alias("is_last"),
            F.transform("_p", lambda x: x["result"]).alias("partials"),
        )
        last = with_current_tree(groups.filter("is_last"), taxonomy)
        inner = groups.filter("NOT is_last").withColumn("current_tree", F.array().cast(TAXONOMY_UPDATE))
        results = map_model(last.unionByName(inner), combine, ["root_id", "batch_no", "span", "is_last"], TAXONOMY_UPDATE)
        failures = failed(results)
        lost.append(failures.select("root_id", F.lit(-level).cast("bigint").alias("batch_no"), "error"))
        good = succeeded(results).join(failures.select("root_id").distinct(), "root_id", "left_anti")
        done.append(good.filter("is_last").select("root_id", "batch_no", "result"))
        nodes = cut(good.filter("NOT is_last").drop("is_last"), "partial-answers")
    none = answers.select("root_id", "batch_no", F.lit("").alias("error")).filter("false")
    return reduce(DataFrame.unionByName, done, answers.select("root_id", "batch_no", "result").filter("false")), reduce(DataFrame.unionByName, lost, none)


def merge_roots(taxonomy: DataFrame, answers: DataFrame) -> DataFrame:
    """Trees of all answered roots, whatever they hold, and of the roots without answer."""
    kept = taxonomy.join(answers.select("root_id").distinct(), "root_id", "left_anti")
    return kept.unionByName(taxonomy_rows(answers))
