"""Reactions: from the export's loose maps to ordered, typed arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadloom.schemas import RAW_REACTIONS, REACTIONS


def typed_reactions(raw: Column) -> Column:
    """``array<map>`` → ``array<struct<emoji,count>>``; NULL becomes empty.

    A reaction without emoji takes its ``type`` (or ``?``); a missing or
    unreadable count is 0.
    """
    typed = F.transform(
        raw,
        lambda r: F.struct(
            F.coalesce(r["emoji"], r["type"], F.lit("?")).alias("emoji"),
            F.coalesce(r["count"].try_cast("bigint"), F.lit(0).cast("bigint")).alias("count"),
        ),
    )
    return F.coalesce(typed, F.array().cast(REACTIONS))


def parse_reactions(json_text: Column) -> Column:
    """JSON text → typed reactions; NULL or bad JSON becomes an empty array."""
    return typed_reactions(F.from_json(json_text, RAW_REACTIONS))


def top_reactions(reactions: Column, n: int = 2) -> Column:
    """The n largest by count; equal counts keep their order."""
    ranked = F.transform(
        reactions,
        lambda r, i: F.struct((-r["count"]).alias("rank"), i.alias("pos"), r.alias("r")),
    )
    return F.transform(F.slice(F.sort_array(ranked), 1, n), lambda x: x["r"])


def reaction_suffix(reactions: Column) -> Column:
    """`` {rxn: 👍3 🔥2}``, or '' without reactions."""
    shown = F.transform(
        top_reactions(reactions, 2),
        lambda r: F.concat(r["emoji"], r["count"].cast("string")),
    )
    return F.when(
        F.size(reactions) > 0, F.concat(F.lit(" {rxn: "), F.array_join(shown, " "), F.lit("}"))
    ).otherwise(F.lit(""))
