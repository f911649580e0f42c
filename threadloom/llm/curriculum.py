"""Mixing sources to target weights by a time-varying curriculum.

Each source has a target in words and a schedule: a piecewise-linear weight over
training time. The integral of the schedule, scaled to the target, is the
source's cumulative demand. Documents stand in a fixed pseudo-random order in
their source's stream (which may run twice); inverting the demand at a copy's
place in the stream gives its training position, and sorting by position gives
the mixed corpus. All steps are DataFrame work.

No window sees a whole source: sums go by hash prefix of the order key in two
levels of 4096, then within one prefix.

Defined cases: NULL text has no words; NULL is a source of its own, last in
order. Ties in the order key go by row number. An empty table gives no rows; if
all sizes are 0, targets are 0. Columns other than those named are not read by
``mix`` and pass through ``mixed_documents`` unchanged.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.lineage import cut
from threadloom.llm.common import ROW, numbered

WORD = r"[^\x20\x09-\x0D]+"
Schedule = tuple[tuple[float, float], ...]


@dataclass(frozen=True)
class MixParams:
    """``weights`` and ``schedules`` repeat over the sources in order. ``share`` of
    all words is asked for; no source gives more than ``repeats`` times its size,
    which is 2 at most: a mix has a first and a second run of a source.
    A schedule is a list of (time, weight) from time 0 to 1, weights above 0."""

    weights: tuple[float, ...] = (3.0, 1.0, 2.0)
    share: float = 1.5
    repeats: int = 2
    schedules: tuple[Schedule, ...] = (
        ((0.0, 1.0), (1.0, 1.0)),
        ((0.0, 2.0), (0.5, 1.0), (1.0, 0.5)),
        ((0.0, 0.5), (0.5, 1.0), (1.0, 2.0)),
    )
    seed: str = "mix"

    def __post_init__(self):
        if self.repeats > 2:
            raise ValueError(f"repeats is {self.repeats}, but a mix has two runs of a source at most")


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def demand_inverse(schedule: Schedule, q: str) -> str:
    """SQL (of any dialect) for the time at which the share ``q`` (0 to 1) of a source's demand is met."""
    number = "cast({!r} AS double)".format
    pieces = [
        (t0, v0, (v1 - v0) / (t1 - t0), (v0 + v1) / 2 * (t1 - t0))
        for (t0, v0), (t1, v1) in zip(schedule, schedule[1:])
    ]
    total, done, cases = sum(p[3] for p in pieces), 0.0, []
    for t0, v0, slope, area in pieces:
        # Solve v0*x + slope*x*x/2 = c in the form that is stable for small slopes.
        c = f"({q} * {number(total)} - {number(done)})"
        root = f"sqrt(greatest({number(0.0)}, {number(v0 * v0)} + {number(2 * slope)} * {c}))"
        x = f"{number(t0)} + {number(2.0)} * {c} / ({number(v0)} + {root})"
        done += area
        cases.append((f"{q} * {number(total)} <= {number(done)}", x))
    when = " ".join(f"WHEN {test} THEN {x}" for test, x in cases[:-1])
    return f"CASE {when} ELSE {cases[-1][1]} END" if when else cases[-1][1]


def source_targets(sizes: DataFrame, p: MixParams) -> DataFrame:
    """(source, source_size, rank, target) from (source, size) rows.

    One row per source: the level at which capped sources stand at their cap and
    all others share the rest by weight is found from sorted caps.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in p.weights])
    ranked = totals.withColumn("rank", F.row_number().over(order) - 1)
    ranked = ranked.withColumn("weight", F.element_at(weights, (F.col("rank") % len(p.weights) + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.col("source_size") * float(p.repeats))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    everything = Window.partitionBy()
    level = ranked.withColumn(
        "level",
        (F.sum("source_size").over(everything) * p.share
         - F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        / F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)),
    )
    first = F.min(
        F.when(F.col("level") <= F.col("cap") / F.col("weight"),
               F.struct((F.col("cap") / F.col("weight")).alias("r"), "rank", "level"))
    ).over(everything)
    return level.select(
        "source", "source_size", "rank",
        F.coalesce(F.least(F.col("cap"), first["level"] * F.col("weight")), F.col("cap")).alias("target"),
    )


def mix(rows: DataFrame, p: MixParams | None = None, id_col: str = "doc_id") -> DataFrame:
    """What the mix takes of every row of (ROW, id, source, size).

    Adds source_size, target, taken, words_1 and words_2 (words taken of the
    first and the second run of the source), first_position and second_position
    (0 to 1, NULL where nothing is taken) and ``turn``, a number to sort by.
    """
    p = p or MixParams()
    targets = source_targets(rows, p).withColumn("quota", F.floor(F.col("target") + 0.5).cast("long"))
    key = F.md5(F.concat(F.lit(f"{p.seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    keyed = rows.withColumn("key", key).withColumn("near", F.substring("key", 1, 6)).withColumn("far", F.substring("key", 1, 3))
    fine = keyed.groupBy("source", "far", "near").agg(F.sum("size").alias("s"))
    coarse = fine.groupBy("source", "far").agg(F.sum("s").alias("s"))

    def before(*by):
        return Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)

    def same(a, b, *names):
        return [F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}")) for n in names]

    coarse = coarse.withColumn("far_start", F.coalesce(F.sum("s").over(before("source", "far")), F.lit(0)))
    fine = fine.withColumn("near_start", F.coalesce(F.sum("s").over(before("source", "far", "near")), F.lit(0)))
    starts = (
        fine.alias("f").join(coarse.alias("c"), same("f", "c", "source", "far"))
        .join(targets.alias("t"), same("f", "t", "source"))
        .select("f.source", "f.near", (F.col("near_start") + F.col("far_start")).alias("bucket_start"),
                "source_size", "rank", "target", "quota")
    )
    inside = Window.partitionBy("source", "near").orderBy("key", id_col, "size", ROW).rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = (
        placed.alias("d").join(starts.alias("s"), same("d", "s", "source", "near"))
        .select("d.*", "source_size", "rank", "target", "quota", (F.col("bucket_start") + F.col("inside")).alias("start"))
    )

    def run(k: int) -> Column:
        left = F.col("quota") - F.col("source_size") * k - F.col("start")
        return F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), left)).cast("long")

    def position(k: int) -> Column:
        mid = F.col("source_size") * k + F.col("start") + F.col(f"words_{k + 1}") / 2.0
        at = F.lit(None).cast("double")
        for i, schedule in enumerate(p.schedules):
            at = F.when(F.col("rank") % len(p.schedules) == i, F.expr(demand_inverse(schedule, "q"))).otherwise(at)
        return mid / F.nullif(F.col("quota"), F.lit(0)), at

    placed = placed.withColumn("words_1", run(0)).withColumn("words_2", run(1))
    for k, name in enumerate(("first_position", "second_position")):
        q, at = position(k)
        placed = placed.withColumn("q", q).withColumn(name, F.when(F.col(f"words_{k + 1}") > 0, F.round(at, 6)))
    waiting = 1.0 + F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / float(2**32)
    return placed.select(
        ROW, id_col, "source", "size", "source_size", "target",
        (F.col("words_1") + F.col("words_2")).alias("taken"), "words_1", "words_2",
        "first_position", "second_position", F.coalesce("first_position", waiting).alias("turn"),
    )


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(ROW, F.col(id_col), F.col(source_col).alias("source"), words(F.col(text_col)).alias("size"))


def mix_report(
    docs: DataFrame, p: MixParams | None = None, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``mix`` for every document, in order of first position (untaken ones after the end)."""
    narrow = docs.select(
        F.col(id_col), F.col(source_col).alias("source"), words(F.col(text_col)).alias("size")
    )
    return mix(numbered(narrow, "mix-sizes"), p, id_col).orderBy("turn", id_col).drop(ROW, "turn")


def mixed_documents(
    docs: DataFrame, p: MixParams | None = None, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The mixed corpus: every copy that is taken, in order of training position.

    Columns are those of ``docs``. A copy taken in part (at most one per source)
    keeps the words that are taken; all others are whole.
    """
    columns = docs.columns
    stored = numbered(docs, "mix-documents")
    plan = cut(mix(sized(stored, id_col, text_col, source_col), p, id_col), "mix-plan")
    copies = plan.select(
        F.col(ROW), F.col("size").alias("__size"),
        F.explode(F.array(
            F.struct(F.col("first_position").alias("at"), F.col("words_1").alias("n")),
            F.struct(F.col("second_position").alias("at"), F.col("words_2").alias("n")),
        )).alias("__copy"),
    ).filter("__copy.n > 0").select(F.col(ROW), "__size", F.col("__copy.at").alias("__at"), F.col("__copy.n").alias("__n"))
    joined = stored.join(copies, ROW)
    # Pieces are a word with the white space behind it; white space in front is a piece of its own.
    pieces = F.split(text_col, r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    lead = F.when(F.col(text_col).rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    head = F.array_join(F.slice(pieces, F.lit(1), (F.col("__n") + lead).cast("int")), "")
    taken = F.when(F.col("__n") < F.col("__size"), head).otherwise(F.col(text_col))
    return joined.withColumn(text_col, taken).orderBy("__at", ROW).select(*columns)
