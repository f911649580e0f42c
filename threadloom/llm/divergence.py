"""Source divergence audit: how the sources of a language differ, and by which terms.

Terms are counted per (language, source) inside the tasks that read the texts;
what moves are their counts, dealt by (language, term). Each language keeps the
terms of at least ``least_docs`` of its documents.

``term`` part, by dominance skyband: a term with a higher count in the group, a
lower one in the language and an earlier place in UTF-8 order can only rank
before another. Every partition retains of each group the terms that fewer than
``k`` others dominate, the bands of all partitions are merged the same way, and
what is left is ranked by exact values. A dominated term has k dominators inside
the band itself, so the first k ranks are never lost.

``pair`` part: sums over all kept terms for all pairs of sources, which the
result holds anyway. Blocks of terms meet the sources of their language as one
matrix; a block's sums are added up by Spark.

Defined cases: NULL text, language or source count as ''. A language without
kept terms gives value 0 for all its pairs and no terms; a group whose texts hold
no term still has its row in every pair. Repeated rows count repeatedly. Ids are
not used. Equal values rank by item. An empty table gives no rows. Columns other
than the three are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.lineage import cut

#: Letters of a term, with A-Z as a-z; every other ASCII byte is a blank.
LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
SCALE = 1_000_000_000


@dataclass(frozen=True)
class DivergenceParams:
    """``held``: counts that a task keeps before it sends them on. ``cells``: of one
    matrix of terms and sources, about; more, up to 80 times as many, where sources are many."""

    least_docs: int = 10
    k: int = 10
    held: int = 300_000
    cells: int = 100_000


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def count_terms(docs: DataFrame, p: DivergenceParams) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, several rows per key."""
    held_most = p.held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[bytes, bytes], tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                terms = text.translate(LETTERS).split()
                n, docs = found.setdefault((lang, source), (Counter(), Counter()))
                held -= len(n)
                n.update(terms)
                docs.update(set(terms))
                held += len(n)
                if held >= held_most:
                    yield from rows(found)
                    found, held = {}, 0
        yield from rows(found)

    def rows(found: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in found.items():
            terms = list(n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x] * len(terms), pa.binary()).cast(pa.string()) if i < 2 else pa.array(terms, pa.binary()).cast(pa.string())
                    for i, x in enumerate((lang, source, None))
                ] + [pa.array([c[t] for t in terms], pa.int64()) for c in (n, docs)],
                names=["lang", "source", "term", "n", "docs"],
            )

    return docs.select(*(_text(c).cast("binary") for c in ("lang", "source", "text"))).mapInArrow(
        run, "lang string, source string, term string, n long, docs long"
    )


def kept_cells(docs: DataFrame, p: DivergenceParams) -> DataFrame:
    """(lang, term, source, n, lang_n) of kept terms, for n > 0; written once."""
    # Dealt by language and term, so that both sums find their rows in place.
    dealt = count_terms(docs, p).repartition("lang", "term")
    cells = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    summed = cells.select(
        "lang", "term", "source", "n", F.sum("n").over(term).alias("lang_n"), F.sum("docs").over(term).alias("lang_docs")
    )
    return cut(summed.filter(F.col("lang_docs") >= p.least_docs).drop("lang_docs"), "divergence-cells")


def skyband(n: np.ndarray, lang_n: np.ndarray, terms: np.ndarray, k: int) -> np.ndarray:
    """Indices of the terms that fewer than k others dominate.

    In this order every dominator comes before what it dominates, and k of a
    dropped term's dominators are retained: comparing with these is enough.
    """
    place = np.empty(len(terms), np.int64)
    place[np.argsort(terms, kind="stable")] = np.arange(len(terms))
    order = np.lexsort((place, lang_n, -n))
    kept = np.empty(0, np.int64)
    for at in range(0, len(order), 256):
        some = order[at : at + 256]
        by = np.zeros(len(some), np.int64)
        for others, earlier in ((kept, False), (some, True)):
            over = (lang_n[others][None, :] <= lang_n[some][:, None]) & (place[others][None, :] < place[some][:, None])
            by += (np.tril(over, -1) if earlier else over).sum(axis=1)
        kept = np.concatenate([kept, some[by < k]])
    return kept


def bands(cells: DataFrame, k: int) -> DataFrame:
    """The skyband of each group within each partition; one group at a time is held."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = [], 0

        def reduced() -> pd.DataFrame:
            df = pd.concat(held, ignore_index=True) if len(held) > 1 else held[0].reset_index(drop=True)
            terms = np.array([t.encode() for t in df["term"]], dtype=object)
            return df.iloc[skyband(df["n"].to_numpy(), df["lang_n"].to_numpy(), terms, k)]

        for frame in frames:
            new = (frame[["lang", "source"]] != frame[["lang", "source"]].shift()).any(axis=1).to_numpy()
            starts = [*np.flatnonzero(new), len(frame)]
            for a, b in zip(starts, starts[1:]):
                part = frame.iloc[a:b]
                if held and (held[0]["lang"].iat[0], held[0]["source"].iat[0]) != (part["lang"].iat[0], part["source"].iat[0]):
                    yield reduced()
                    held, rows = [], 0
                held.append(part)
                rows += b - a
                if rows >= 50_000:
                    held, rows = [reduced()], 0
        if held:
            yield reduced()

    return cells.sortWithinPartitions("lang", "source").mapInPandas(run, cells.schema)


def share(n: str, total: str, kept: str) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * kept)), in whole numbers of any size."""
    return F.expr(f"1 + (CAST({SCALE} AS DECIMAL(18,0)) * CAST({n} + 2 AS DECIMAL(20,0))) div CAST({total} + 2 * {kept} AS DECIMAL(20,0))")


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    gap = p - q
    return gap * gap // (p + q)


def _pairs(cells: DataFrame, groups: DataFrame, langs: DataFrame, p: DivergenceParams) -> DataFrame:
    """(lang, source, item, value) for all pairs of sources of a language."""
    # With four terms a source or more in a block, its sums are fewer than its cells.
    size = F.least(F.greatest(F.lit(p.cells), 4 * F.col("sources") * F.col("sources")), F.lit(80 * p.cells))
    sized = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(langs, "lang").select(
        "lang", F.greatest(F.lit(1), F.ceil(F.col("kept") * F.col("sources") / size)).cast("long").alias("blocks")
    )
    block = F.pmod(F.xxhash64("term"), F.col("blocks"))
    left = cells.join(sized, "lang").select("lang", block.alias("block"), "term", "source", "n")
    right = groups.join(sized, "lang").select(
        "lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "source", "total", "kept"
    )

    def run(key, some: pd.DataFrame, roster: pd.DataFrame) -> pd.DataFrame:
        roster = roster.sort_values("source", ignore_index=True)
        at, term = pd.Index(roster["source"]).get_indexer(some["source"]), pd.factorize(some["term"])[0]
        over = (roster["total"].astype(object) + 2 * roster["kept"].astype(object)).to_numpy()
        shares = np.empty((term.max() + 1 if len(term) else 0, len(roster)), np.int64)
        if len(shares):
            shares[:] = (1 + SCALE * 2 // over).astype(np.int64)
            shares[term, at] = (1 + SCALE * (some["n"].to_numpy().astype(object) + 2) // over[at]).astype(np.int64)
        rows = []
        for i in range(len(roster) - 1):
            value = divergence(shares[:, i + 1 :], shares[:, i : i + 1]).sum(axis=0)
            for a, b in ((np.full(len(value), i), np.arange(i + 1, len(roster))), (np.arange(i + 1, len(roster)), np.full(len(value), i))):
                rows.append(pd.DataFrame({"source": roster["source"].to_numpy()[a], "item": roster["source"].to_numpy()[b], "value": value}))
        rows.append(pd.DataFrame({"source": [], "item": [], "value": []}).astype({"source": object, "item": object, "value": np.int64}))
        return pd.concat(rows, ignore_index=True).assign(lang=key[0]).astype({"lang": object})

    parts = left.groupBy("lang", "block").cogroup(right.groupBy("lang", "block")).applyInPandas(
        run, "lang string, source string, item string, value long"
    )
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def source_divergence(docs: DataFrame, params: DivergenceParams | None = None) -> DataFrame:
    """(lang, source, part, item, value, rank) as the module says."""
    p = params or DivergenceParams()
    cells = kept_cells(docs, p)
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = cells.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_distinct("term").alias("kept"))
    seen = docs.select(_text("lang").alias("lang"), _text("source").alias("source")).distinct()
    langs = cut(
        seen.select("lang").distinct().join(langs, "lang", "left").na.fill(0, ["lang_total", "kept"]), "divergence-langs"
    )
    groups = cut(
        seen.join(totals, ["lang", "source"], "left").join(langs.select("lang", "kept"), "lang").na.fill(0, ["total"]),
        "divergence-groups",
    )
    pairs = _pairs(cells, groups, langs, p)
    merged = bands(bands(cells, p.k).repartition("lang", "source"), p.k)
    terms = merged.join(groups, ["lang", "source"]).join(langs.select("lang", "lang_total"), "lang")
    terms = terms.select("lang", "source", F.col("term").alias("item"), share("n", "total", "kept").alias("p"), share("lang_n", "lang_total", "kept").alias("q"))
    terms = terms.filter("p > q").select("lang", "source", "item", F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = terms.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= p.k)
    return (
        pairs.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
        .unionByName(ranked.withColumn("part", F.lit("term")))
        .select("lang", "source", "part", "item", "value", "rank")
    )
