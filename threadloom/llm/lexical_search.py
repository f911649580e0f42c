"""Ranked lexical search by NRA (no random access).

The index holds per document the counts of all asked terms; statistics (number
of documents, their lengths, documents per term) cover the whole table. Tasks
search their part of the index in blocks of documents: the postings of a term
are sorted by impact, an item reads its lists from the top, and every document
has a lower bound (what was seen) and an upper one (plus the next unread impact
of each list in which it was not seen yet). A list is read on while a document
that can still enter the best k, or tie with the last of them, has an open
interval; so members, ties and scores are final when reading ends. The k-th
score found so far in the task is a floor for its later blocks. What the tasks
report, at most k rows per item each, is ranked once more.

Items are asked in passes of bounded size over the same documents, so neither
their number nor that of documents bounds the other.

Defined cases: a NULL text has no terms, and such a document counts nowhere. An
item without a term, or whose terms no document holds, has no rows. Every row of
items is an item of its own and every row of documents a document, also under
repeated or NULL ids; NULL ids come last among equal scores. Empty tables give no
rows. Columns other than ids and texts are not read, so their names cannot clash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from threadloom.lineage import cut
from threadloom.llm.common import ROW, numbered

SCALE = 1_000_000_000

#: Bytes of a term, with A-Z as a-z; every other ASCII byte is a blank.
TERM_BYTES = bytes(
    b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)


@dataclass(frozen=True)
class SearchParams:
    """``k`` results per item. ``pass_bytes``: item texts of one pass, about.
    ``block_docs`` and ``block_postings`` bound a block; ``first_read`` postings of
    a list are read first, then twice as many each time."""

    k: int = 10
    pass_bytes: int = 4_000_000
    block_docs: int = 16_384
    block_postings: int = 4_000_000
    first_read: int = 64


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


def index_terms(docs: DataFrame, id_col: str, text_col: str, numbers: dict[bytes, int], label: str) -> tuple[DataFrame, int, int]:
    """Stored (id, n, terms, counts) of documents with an asked term; documents with terms, and all their terms."""
    asked = docs.sparkSession.sparkContext.broadcast(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = asked.value
        for batch in batches:
            sizes, terms, counts = [], [], []
            for text in batch.column(1).to_pylist():
                words = terms_of(text) if text is not None else []
                found = [(known[t], c) for t, c in Counter(words).items() if t in known]
                sizes.append(len(words))
                terms.append([t for t, _ in found])
                counts.append([c for _, c in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                names=["id", "n", "terms", "counts"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    seen = Observation()
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(
        run, f"id {kind}, n long, terms array<int>, counts array<long>"
    )
    # Sums over no rows are NULL.
    read = read.observe(seen, F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("all"))
    stored = cut(read.filter(F.size("terms") > 0), label)
    return stored, seen.get["docs"], seen.get["all"] or 0


class Lists:
    """Postings of a block of documents: per term documents and impacts, largest impact first."""

    def __init__(self, terms: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n_terms: int):
        order = np.lexsort((docs, -impacts, terms))
        self.docs, self.impacts = docs[order], impacts[order]
        self.starts = np.searchsorted(terms[order], np.arange(n_terms + 1))

    def best(self, wanted: np.ndarray, times: np.ndarray, n_docs: int, k: int, floor: int, first: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and exact scores, among them all of score above 0 that are one of the best k, tie with the last, or reach ``floor``."""
        at, ends = self.starts[wanted].copy(), self.starts[wanted + 1]

        def next_impacts() -> np.ndarray:
            left = at < ends
            out = np.zeros(len(at), np.int64)
            out[left] = self.impacts[at[left]] * times[left]
            return out

        lower, seen = np.zeros(n_docs, np.int64), np.zeros((n_docs, len(at)), bool)
        # Open: documents whose upper bound reaches the k-th lower bound.
        open_, step, unread = np.arange(n_docs), first, next_impacts()
        least = max(floor, 1)
        if unread.sum() < least:
            return open_[:0], lower[:0]
        reading = np.flatnonzero(unread)
        while len(reading):
            for i in reading:
                to = min(at[i] + step, ends[i])
                part = slice(at[i], to)
                lower[self.docs[part]] += self.impacts[part] * times[i]
                seen[self.docs[part], i] = True
                at[i] = to
            step *= 2
            unread = next_impacts()
            if n_docs >= k:
                least = max(least, int(np.partition(lower, n_docs - k)[n_docs - k]))
            missing = ~seen[open_]
            upper = lower[open_] + missing @ unread
            stays = upper >= least
            open_, missing, upper = open_[stays], missing[stays], upper[stays]
            unsure = upper > lower[open_]
            # A list matters while some document with an open interval may be in its unread part.
            reading = np.flatnonzero(missing[unsure].any(axis=0) & (unread > 0)) if unsure.any() else np.empty(0, np.int64)
        open_ = open_[lower[open_] >= least]
        return open_, lower[open_]


def _blocks(batches: Iterator[pa.RecordBatch], docs_most: int, postings_most: int) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, lengths, places of documents, terms, counts) of whole documents up to a bounded size."""
    ids: list = []
    sizes: list[int] = []
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held = 0

    def block():
        return ids, np.array(sizes, object), *(np.concatenate(x) for x in zip(*parts))

    for batch in batches:
        for i in range(0, batch.num_rows, 1024):
            some = batch.slice(i, 1024)
            lengths = some.column(2).value_lengths().to_numpy()
            if ids and (len(ids) + len(lengths) > docs_most or held + lengths.sum() > postings_most):
                yield block()
                ids, sizes, parts, held = [], [], [], 0
            places = np.repeat(np.arange(len(ids), len(ids) + len(lengths)), lengths)
            parts.append((places, some.column(2).flatten().to_numpy(), some.column(3).flatten().to_numpy()))
            ids.extend(some.column(0).to_pylist())
            sizes.extend(some.column(1).to_pylist())
            held += int(lengths.sum())
    if ids:
        yield block()


def search_index(index: DataFrame, items: list[tuple], weights: dict[int, int], n_docs: int, n_all: int, p: SearchParams) -> DataFrame:
    """(item, id, score): the best of every task for each (item, terms, times)."""
    context = index.sparkSession.sparkContext
    asked = context.broadcast((items, weights))
    widest = max((len(terms) for _, terms, _ in items), default=1)
    docs_most = max(1024, min(p.block_docs, 2**27 // max(1, widest)))
    k, first, postings_most = p.k, p.first_read, p.block_postings

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, weight_of = asked.value
        weight = np.zeros(max(weight_of, default=-1) + 1, np.int64)
        weight[list(weight_of)] = list(weight_of.values())
        best: dict = {}  # item: best (minus score, NULL id, id), best first
        for ids, sizes, places, terms, counts in _blocks(batches, docs_most, postings_most):
            # Whole numbers of any size, as lengths times documents can pass 64 bits.
            m = (25 + 75 * n_docs * sizes // n_all).astype(np.int64)
            impacts = weight[terms] * (SCALE * counts // (1000 * counts + 8 * m[places]))
            lists = Lists(terms, places, impacts, len(weight))
            place = np.empty(len(ids), np.int64)
            place[sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0))] = np.arange(len(ids))
            for item, of, times in wanted:
                top = best.get(item, [])
                floor = -top[-1][0] if len(top) == k else 0
                docs, scores = lists.best(np.asarray(of), np.asarray(times), len(ids), k, floor, first)
                if len(docs):
                    order = np.lexsort((place[docs], -scores))[:k]
                    new = [(-int(scores[i]), ids[docs[i]] is None, ids[docs[i]]) for i in order]
                    best[item] = sorted(top + new, key=lambda x: (x[0], x[1], 0 if x[1] else x[2]))[:k]
        rows = [(item, id_, -score) for item, top in best.items() for score, _, id_ in top]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], id_type), pa.array([r[2] for r in rows], pa.int64())],
            names=["item", "id", "score"],
        )

    id_type = to_arrow_type(index.schema["id"].dataType)
    return index.mapInArrow(run, f"item long, id {index.schema['id'].dataType.simpleString()}, score long")


def search(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", params: SearchParams | None = None,
) -> DataFrame:
    """(item id, rank, document id, score): the best ``k`` documents of every item, equal scores by id."""
    p = params or SearchParams()
    stored = numbered(items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")), "search-items")
    size = stored.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, math.ceil(size / p.pass_bytes))
    found = None
    for i in range(passes):
        some = stored.filter(F.pmod(F.xxhash64(ROW), F.lit(passes)) == i).select(ROW, F.col("text").cast("binary")).collect()
        asked = [(row[0], Counter(terms_of(bytes(row[1] or b"")))) for row in some]
        numbers = {t: n for n, t in enumerate(sorted({t for _, terms in asked for t in terms}))}
        index, n_docs, n_all = index_terms(docs, id_col, text_col, numbers, "search-index")
        held = index.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
        weights = {r["term"]: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["count"] + 1))) for r in held}
        wanted = []
        for item, terms in asked:
            # Terms that no document holds have no postings.
            of = [(numbers[t], c) for t, c in terms.items() if numbers[t] in weights]
            if of:
                wanted.append((item, [t for t, _ in of], [c for _, c in of]))
        part = search_index(index, wanted, weights, n_docs, n_all, p)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= p.k)
    return ranked.join(stored.select(F.col(ROW).alias("item"), "item_id"), "item").select(
        F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score"
    )
