"""Threads → summaries → roots → taxonomy → knowledge graph.

Each phase is one DataFrame job whose result is a written table; the next phase
reads that table, which is the barrier between them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.lineage import cut
from threadloom.operators.graph import edges, entities
from threadloom.operators.models import failed, map_model, succeeded
from threadloom.operators.retrieval import load_threads
from threadloom.operators.routing import route_by_lexicon, route_by_model
from threadloom.operators.taxonomy import induce_taxonomy
from threadloom.operators.triplets import extract_triplets, parse_relationships

TAXONOMY = "root_id string, domain string, topic string"


def one_summary(
    results: DataFrame, lost: DataFrame, combine: Callable[[dict], str] | None
) -> tuple[DataFrame, DataFrame]:
    """(thread_id, summary) from the summaries of all parts, and failed threads."""
    if "part_no" not in results.columns:
        results = results.withColumn("part_no", F.lit(0))
    whole = results.join(lost.select("thread_id"), "thread_id", "left_anti")
    parts = whole.groupBy("thread_id").agg(
        F.sort_array(F.collect_list(F.struct("part_no", "result"))).alias("_p")
    ).select("thread_id", F.transform("_p", lambda x: x["result"]).alias("parts"))
    if combine is None:
        summaries = cut(parts.select("thread_id", F.array_join("parts", "\n").alias("summary")), "summaries")
        return summaries, lost.limit(0)
    merged = map_model(parts, combine, ["thread_id"], "string")
    return succeeded(merged).withColumnRenamed("result", "summary"), failed(merged).select("thread_id", "error")


def run_enrichment(
    threads: DataFrame,
    summarise: Callable[[dict], str],
    where: Column | None = None,
    route: Callable[[dict], str] | None = None,
    lexicon: list[tuple[str, str]] | None = None,
    induce: Callable[[dict], list[dict]] | None = None,
    extract: Callable[[dict], list[dict]] | None = None,
    taxonomy: DataFrame | None = None,
    combine: Callable[[dict], str] | None = None,
    holds: Column | None = None,
    lacks: Column | None = None,
) -> dict[str, DataFrame]:
    """Tables ``summaries``, ``anchored``, ``taxonomy``, ``entities``, ``edges``, ``failed``.

    ``summarise`` is called per gold row (``thread_id``, ``part_no``, ``transcript``). The
    answers of a thread's parts then become its one summary: ``combine`` gets
    ``thread_id`` and ``parts`` (summaries in order), for threads of one part too;
    without it they are joined by line breaks. A thread fails if one call fails.

    Routing uses the model ``route`` or, without one, the ``lexicon``. Triplets
    come from the model ``extract`` or, without one, from the relation lines of
    packet summaries. Failed items of any phase are listed with phase and error.
    ``where``, ``holds`` and ``lacks`` choose the threads, as for ``load_threads``.
    """
    spark = threads.sparkSession
    work = load_threads(threads, where, holds, lacks)
    keys = [c for c in ("thread_id", "part_no") if c in work.columns]
    results = map_model(work, summarise, keys, "string")
    lost = failed(results).groupBy("thread_id").agg(F.min("error").alias("error"))
    summaries, more = one_summary(succeeded(results), lost, combine)
    lost = lost.unionByName(more)
    errors = [lost.select("thread_id", F.lit("summary").alias("phase"), "error")]

    if route is not None:
        anchored = route_by_model(summaries, route)
    else:
        anchored = cut(route_by_lexicon(summaries, lexicon or []), "anchored")

    tree = taxonomy if taxonomy is not None else spark.createDataFrame([], TAXONOMY)
    if induce is not None:
        tree, lost = induce_taxonomy(anchored, tree, induce)
        errors.append(
            lost.select(
                F.concat_ws(" ", "root_id", "batch_no").alias("thread_id"),
                F.lit("taxonomy").alias("phase"),
                "error",
            )
        )

    if extract is not None:
        triplets, lost = extract_triplets(anchored, extract)
        errors.append(lost.select("thread_id", F.lit("triplets").alias("phase"), "error"))
    else:
        triplets = parse_relationships(anchored)
    # Runs write edges in thread order; the last one of equal edges wins.
    numbered = triplets.withColumn("seq", F.struct("thread_id", "pos"))
    edge_table = cut(edges(numbered), "edges")

    all_failed = errors[0]
    for e in errors[1:]:
        all_failed = all_failed.unionByName(e)
    return {
        "summaries": summaries,
        "anchored": anchored,
        "taxonomy": tree,
        "entities": entities(edge_table),
        "edges": edge_table,
        "failed": all_failed,
    }
