"""Subject–predicate–object triplets from summaries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.functions.text import strip
from threadloom.operators.models import failed, map_model, succeeded
from threadloom.operators.routing import DEFAULT_TOPIC
from threadloom.schemas import PACKET, TRIPLETS

# Fixed value: the line format "[Subject] -> (predicate) -> [Object]: context".
RELATION_LINE = r"(?s)^\s*\[(.+?)\]\s*->\s*\((.+?)\)\s*->\s*\[(.+?)\]\s*(?::(.*))?$"
FIELDS = ["subject", "predicate", "object", "context"]
SEPARATOR = "\x1f"  # stands between the fields of a matched line


def with_topic(anchored: DataFrame) -> DataFrame:
    root = F.col("root") if "root" in anchored.columns else F.lit(None).cast("string")
    return anchored.select(
        "thread_id", "summary", F.coalesce(root, F.lit(DEFAULT_TOPIC)).alias("topic")
    )


def _triplet_rows(lists: DataFrame) -> DataFrame:
    return lists.select("thread_id", "topic", F.posexplode("triplets").alias("pos", "t")).select(
        "thread_id", "topic", "pos", "t.*"
    )


def extract_triplets(anchored: DataFrame, fn: Callable[[dict], list[dict]]):
    """Triplets from a model, one call per summary, and the failed summaries."""
    results = map_model(with_topic(anchored), fn, ["thread_id", "topic"], TRIPLETS)
    rows = _triplet_rows(succeeded(results).withColumnRenamed("result", "triplets"))
    return rows, failed(results).drop("topic")


def relation_fields(line):
    """The four fields of a relation line as an array; one entry for any other line.

    One replacement finds all fields, so the pattern runs once per line.
    """
    fields = SEPARATOR.join(f"${i}" for i in range(1, 5))
    clean = F.replace(line, F.lit(SEPARATOR), F.lit(" "))
    return F.split(F.regexp_replace(clean, RELATION_LINE, fields), SEPARATOR)


def parse_relationships(anchored: DataFrame) -> DataFrame:
    """Triplets from the relation lines of JSON packets, without a model.

    Lines of another form and summaries that are no packet give no triplets.
    """
    lines = F.from_json("summary", PACKET)["cross_domain_relationships"]
    parsed = with_topic(anchored).select(
        "thread_id", "topic", F.posexplode(F.transform(lines, relation_fields)).alias("pos", "t")
    )
    return parsed.filter(F.size("t") == len(FIELDS)).select(
        "thread_id",
        "topic",
        "pos",
        *[strip(F.get("t", F.lit(i))).alias(n) for i, n in enumerate(FIELDS)],
    )
