"""Repeated passages by a sparse suffix array.

A suffix of a document's words is retained where the hash of its first GRAM
words is the smallest among SPREAD neighbours (a minimiser). A passage of LENGTH
= GRAM + SPREAD - 1 words or more has such a suffix in every document that holds
it, at the same place. Suffixes that start alike and agree in the SPREAD - 1 words
to their left and to their right are one class, however many documents hold it.
The classes of a start are sorted by their words to the right and left, and
neighbours compared: equal ones to both sides, LENGTH words in all, repeat. Every
division of the words between the sides has its own order, so no match hides
behind a longer one to one side only. Classes report their stretches to their
suffixes, one row each, and those of a document that follow one another are joined.

The classes of one start go through one task, up to RUN of them. Beyond, the
same equality is counted by an aggregation, so no task holds them all.

Every repeated window of LENGTH words has a source: the smallest id that holds it.
A document's words in stretches of other sources, but for words that also lie in
stretches of its own, can go: each repeated window then stays in its source.

Defined cases: NULL and short texts repeat nothing. A passage that repeats in
one document only, or in rows of equal id and text, does not count; rows of
equal id and different texts are one document. Rows with a NULL id are reported
with NULL and are no source; the source is NULL where no other row holds the
window. An empty table gives no rows. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.lineage import cut, drop, recorded
from threadloom.llm.minhash import Shingler, _mix

LENGTH, GRAM = 50, 26
SPREAD = LENGTH - GRAM + 1
SIDE = SPREAD - 1
RUN, CHUNK = 8192, 16384
PIECE, PLACE_BITS = 1 << 23, np.uint64(24)
PACK = 10  # bits for the two bounds of a suffix
MASK = (1 << PACK // 2) - 1
NONE = np.iinfo(np.int64).max
_STEP = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(words: np.ndarray) -> np.ndarray:
    """Hash of the GRAM words from each place."""
    if len(words) < GRAM:
        return np.empty(0, np.uint64)
    total = np.zeros(len(words) - GRAM + 1, np.uint64)
    for k in range(GRAM):
        total = total * _STEP + words[k:len(words) - GRAM + 1 + k]
    return _mix(total)


def minimisers(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places whose hash is the smallest (leftmost on ties) of SPREAD neighbours, and the
    first and last window that each is the smallest of."""
    found = [np.empty(0, np.int64)]
    for at in range(0, len(grams) - SPREAD + 1, PIECE):
        some = grams[at:at + PIECE + SPREAD - 1]
        # The low bits hold the place in the piece: hashes that differ there only count as ties.
        low = (some >> PLACE_BITS << PLACE_BITS) | np.arange(len(some), dtype=np.uint64)
        width = 1
        while 2 * width <= SPREAD:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < SPREAD:
            low = np.minimum(low[: len(low) - (SPREAD - width)], low[SPREAD - width:])
        found.append((low & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64) + at)
    each = np.concatenate(found)  # of every window
    places, first, n = np.unique(each, return_index=True, return_counts=True)
    return places, first, first + n - 1


@dataclass
class Classes:
    """Suffixes that start and go on alike: words to the right, and to the left in reading order from the suffix.

    ``n_left`` and ``n_right`` bound the windows whose minimiser the suffix is, so that
    every window counts once.
    """

    key: np.ndarray
    left: np.ndarray  # class x SIDE
    right: np.ndarray
    n_left: np.ndarray
    n_right: np.ndarray
    first: np.ndarray  # smallest and largest document
    last: np.ndarray
    source: np.ndarray  # smallest id; NONE without one


def compared(c: Classes) -> tuple[np.ndarray, np.ndarray]:
    """For each number of words to the left and class: whether the window repeats, and its source."""
    found, source = np.zeros((SIDE + 1, len(c.key)), bool), np.full((SIDE + 1, len(c.key)), NONE)
    for a in range(SIDE + 1):
        at = np.flatnonzero((c.n_left >= a) & (c.n_right >= SIDE - a))
        if not len(at):
            continue
        near = np.column_stack([c.right[at, : SIDE - a], c.left[at, :a]]).view(np.uint32)
        rows = np.column_stack([c.key[at].view(np.uint32).reshape(len(at), 2), near])
        order = np.argsort(np.ascontiguousarray(rows).view(f"V{4 * rows.shape[1]}").ravel(), kind="stable")
        rows, at = rows[order], at[order]
        starts = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)])
        several = np.minimum.reduceat(c.first[at], starts) < np.maximum.reduceat(c.last[at], starts)
        run = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(at)]))
        found[a, at] = several[run]
        source[a, at] = np.minimum.reduceat(c.source[at], starts)[run]
    return found, source


def stretches(found: np.ndarray, source: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(class, least, most words to the left, source) of unbroken repeated windows of one source."""
    same = (found[1:] & found[:-1]) & (source[1:] == source[:-1])
    opens = found.copy()
    opens[1:] &= ~same
    closes = found.copy()
    closes[:-1] &= ~same
    for i in np.flatnonzero(found.any(axis=0)).tolist():
        for lo, hi in zip(np.flatnonzero(opens[:, i]).tolist(), np.flatnonzero(closes[:, i]).tolist()):
            yield i, lo, hi, int(source[lo, i])


# ---- Spark side

def _referred(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(ref, doc, id, text): ref tells rows apart by id and text, doc names the document."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ref = F.xxhash64("id", "text")
    return docs.select(ref.alias("ref"), F.coalesce("id", ref).alias("doc"), "id", "text")


def retained(docs: DataFrame) -> DataFrame:
    """(key, ref, place): the sparse suffixes, by the hash of their start; ``place`` packs n_left and n_right."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Shingler(1)
        for whole in batches:
            for batch in (whole.slice(i, 512) for i in range(0, len(whole), 512)):
                keys, places, counts = [], [], []
                for text in batch.column(1):
                    grams = gram_hashes(hashes.word_hashes((text.as_py() or "").encode().split()))
                    at, first, last = minimisers(grams)
                    keys.append(grams[at])
                    counts.append(len(at))
                    # Place and bounds in one number: these rows are many.
                    places.append(at << PACK | (at - first) << (PACK // 2) | (SIDE - (at - last)))
                refs = np.repeat(batch.column(0).to_numpy(), counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(refs), pa.array(np.concatenate(places))], names=["key", "ref", "place"],
                )

    return docs.select("ref", "text").mapInArrow(run, "key long, ref long, place long")


def surrounded(docs: DataFrame) -> DataFrame:
    """(key, ref, doc, id, place, left, right, n_left, n_right) for the listed places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Shingler(1)
        for whole in batches:
            for batch in (whole.slice(i, 128) for i in range(0, len(whole), 128)):
                rows = []
                for ref, doc, name, text, listed in zip(*(c.to_pylist() for c in batch.columns)):
                    words = hashes.word_hashes(text.encode().split())
                    near = np.concatenate([np.zeros(SIDE, np.uint32), (words >> np.uint64(32)).astype(np.uint32), np.zeros(SIDE + 1, np.uint32)])
                    for item in listed:
                        at = item["place"] >> PACK
                        rows.append((
                            item["key"], ref, doc, name, at, near[at:at + SIDE][::-1].tobytes(),
                            near[at + SIDE + GRAM:at + 2 * SIDE + GRAM].tobytes(), item["place"] >> (PACK // 2) & MASK, item["place"] & MASK,
                        ))
                columns = list(zip(*rows)) or [()] * 9
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)],
                    names=["key", "ref", "doc", "id", "place", "left", "right", "n_left", "n_right"],
                )

    return docs.mapInArrow(run, "key long, ref long, doc long, id long, place int, left binary, right binary, n_left int, n_right int")


CLASS = ["key", "left", "right", "n_left", "n_right"]
FOUND = "class long, least int, most int, source long"


def classes_of(suffixes: DataFrame) -> DataFrame:
    """One row per class: its words, smallest and largest document, smallest id."""
    rows = suffixes.groupBy("class").agg(
        *(F.first(c).alias(c) for c in CLASS), F.min("doc").alias("first"), F.max("doc").alias("last"),
        F.coalesce(F.min("id"), F.lit(int(NONE))).alias("source"),
    )
    return cut(rows, "classes")


def _classes(table: pa.Table) -> Classes:
    def sides(name: str) -> np.ndarray:
        return np.frombuffer(b"".join(table.column(name).to_pylist()), np.uint32).reshape(len(table), SIDE)

    return Classes(
        table.column("key").to_numpy(), sides("left"), sides("right"),
        *(table.column(n).to_numpy() for n in ("n_left", "n_right", "first", "last", "source")),
    )


def _stretch_rows(names: np.ndarray, found: np.ndarray, source: np.ndarray) -> pa.RecordBatch:
    i, least, most, whose = zip(*rows) if (rows := list(stretches(found, source))) else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(names[np.array(i, np.int64)], pa.int64()), pa.array(least, pa.int32()), pa.array(most, pa.int32()), pa.array(whose, pa.int64())],
        names=["class", "least", "most", "source"],
    )


def neighbours(classes: DataFrame) -> DataFrame:
    """Repeated stretches of classes, the classes of a start together."""
    tasks = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def matches(table: pa.Table) -> pa.RecordBatch:
        return _stretch_rows(table.column("class").to_numpy(), *compared(_classes(table)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) < CHUNK:
                continue
            table = pa.Table.from_batches(held)
            keys = table.column("key").to_numpy()
            whole = int(np.searchsorted(keys, keys[-1]))  # the last run may go on
            if whole:
                yield matches(table.slice(0, whole))
                held = table.slice(whole).to_batches()
        if held:
            yield matches(pa.Table.from_batches(held))

    return classes.repartition(tasks, "key").sortWithinPartitions("key").mapInArrow(run, FOUND)


def frequent(classes: DataFrame) -> DataFrame:
    """As ``neighbours``, for starts of too many classes for one task: equal windows are counted."""
    window = F.xxhash64("key", "a", F.expr(f"substring(right, 1, 4 * ({SIDE} - a))"), F.expr("substring(left, 1, 4 * a)"))
    windows = classes.withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(SIDE)))).filter(
        (F.col("n_left") >= F.col("a")) & (F.col("n_right") >= SIDE - F.col("a"))
    ).select("class", "a", window.alias("window"), "first", "last", "source")
    equal = windows.groupBy("window").agg(F.min("first").alias("x"), F.max("last").alias("y"), F.min("source").alias("source")).filter("x <> y")
    hits = windows.select("class", "a", "window").join(equal.select("window", "source"), "window")
    listed = hits.groupBy("class").agg(F.collect_list(F.struct("a", "source")).alias("hits"))  # SIDE + 1 at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, source = np.zeros((SIDE + 1, len(batch)), bool), np.full((SIDE + 1, len(batch)), NONE)
            for i, hits in enumerate(batch.column(1).to_pylist()):
                for hit in hits:
                    found[hit["a"], i], source[hit["a"], i] = True, hit["source"]
            yield _stretch_rows(batch.column(0).to_numpy(), found, source)

    return listed.mapInArrow(run, FOUND)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start_word, n_words, source_id): every longest stretch of words of which each
    LENGTH-word window also stands in another document and has the same source.

    Keeping the stretches with ``source_id`` = id, and all words that are in none, keeps
    every repeated window.
    """
    docs = _referred(docs, id_col, text_col)
    with recorded() as first:
        suffixes = cut(retained(docs), "suffixes")
        shared = suffixes.groupBy("key").agg(F.min("ref").alias("a"), F.max("ref").alias("b")).filter("a <> b").select("key")
        # Rows of equal id and text give equal suffixes, which count once.
        listed = suffixes.join(shared, "key").groupBy("ref").agg(F.collect_set(F.struct("key", "place")).alias("listed"))
    texts = docs.join(listed, "ref").select("ref", "doc", "id", "text", "listed")
    around = cut(surrounded(texts).withColumn("class", F.xxhash64(*CLASS)), "surrounded")
    drop(docs.sparkSession, first)
    classes = classes_of(around)
    many = cut(classes.groupBy("key").agg(F.count("*").alias("run")).filter(F.col("run") > RUN).select("key"), "frequent-starts")
    found = neighbours(classes.join(many, "key", "left_anti")).union(frequent(classes.join(many, "key", "left_semi")))
    # Places of the first and the last window of a stretch.
    met = around.select("class", "ref", "id", "place").join(cut(found, "stretches"), "class").select(
        "ref", "id", "source", (F.col("place") - F.col("most")).cast("long").alias("start"), (F.col("place") - F.col("least")).cast("long").alias("end"),
    )
    order = Window.partitionBy("ref", "source").orderBy("start", "end")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    opens = F.when(F.col("start") <= F.max("end").over(before) + 1, 0).otherwise(1)
    islands = met.withColumn("opens", opens).withColumn("island", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = islands.groupBy("ref", "source", "island").agg(
        F.first("id").alias(id_col), F.min("start").alias("start_word"), (F.max("end") - F.min("start") + LENGTH).alias("n_words")
    )
    return merged.select(id_col, "start_word", "n_words", F.nullif("source", F.lit(int(NONE))).alias("source_id"))
