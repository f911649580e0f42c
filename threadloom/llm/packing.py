"""Packing documents into sequences of fixed length by swap-based local search.

Documents become token pieces; only longer ones are cut. Pieces are dealt into
groups of bounded size. Each group starts from a best-fit packing, then its
emptiest bins give pieces away: one piece moves, one is exchanged for a smaller
one, or two for one, always from an emptier to a fuller bin, so that the sum of
squared fills grows, until bins are empty or the fewest possible are left. What
a group leaves in its emptiest bins is packed again across groups.

Defined cases: NULL text is empty; an empty text is the end mark alone, one
token. Repeated rows are packed as often as they come. An empty table gives no
rows. Columns other than id and text are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from threadloom.lineage import cut
from threadloom.llm.tokens import tokenizer


@dataclass(frozen=True)
class PackParams:
    """``tokenizer``: the file. ``size``: tokens of a sequence. ``end``: id after each
    document. ``group``: pieces packed together. ``donors``: how many of the emptiest
    bins, for each bin above the lower bound, the search tries to empty (effort only)."""

    tokenizer: str
    size: int = 4096
    end: int = 1
    group: int = 16384
    donors: int = 4


# ---- pieces

PIECE_FIELDS = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]


def pieces_of(docs: DataFrame, p: PackParams, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32), one row per piece."""
    kind = docs.schema[id_col].dataType.simpleString()
    end = np.asarray([p.end], dtype="<u4").tobytes()

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(p.tokenizer)
        for batch in batches:
            take, rows = [], []
            for i, text in enumerate(batch.column(1)):
                ids = encode.ids(text.as_py() or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * p.size)):
                    part = ids[at:at + 4 * p.size]
                    take.append(i)
                    rows.append((k, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(take, pa.int32()))]
                + [pa.array(c, t) for c, (_, t) in zip(columns, PIECE_FIELDS)],
                names=[id_col] + [n for n, _ in PIECE_FIELDS],
            )

    return docs.select(id_col, text_col).mapInArrow(
        tokenise, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long"
    )


# ---- local search inside a group

def best_fit(sizes: np.ndarray, cap: int) -> list[list[int]]:
    """Bins of item numbers: largest first, each into the fullest bin that takes it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(cap + 1)]
    rooms = 0  # bit r: a bin with room r is open
    for i in np.argsort(-sizes, kind="stable").tolist():
        s = int(sizes[i])
        fits = rooms >> s
        if fits:
            room = s + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = cap, len(bins)
            bins.append([i])
        if room > s:
            by_room[room - s].append(b)
            rooms |= 1 << (room - s)
    return bins


class Packing:
    """Bins of a group, as an assignment of items with the fill of each bin."""

    def __init__(self, sizes: np.ndarray, cap: int, bins: list[list[int]]):
        self.sizes, self.cap = sizes, cap
        self.of = np.empty(len(sizes), dtype=np.int64)
        for b, items in enumerate(bins):
            self.of[items] = b
        self.fill = np.bincount(self.of, weights=sizes, minlength=len(bins)).astype(np.int64)

    def lower_bound(self) -> int:
        return -(-int(self.sizes.sum()) // self.cap)

    def used(self) -> int:
        return int((self.fill > 0).sum())

    def shift(self, items: list[int], to: int, back: int | None) -> None:
        """Move ``items`` from their bin to ``to``, and ``back`` the other way."""
        frm, amount = int(self.of[items[0]]), int(self.sizes[items].sum())
        self.of[items] = to
        if back is not None:
            self.of[back] = frm
            amount -= int(self.sizes[back])
        self.fill[to] += amount
        self.fill[frm] -= amount

    def reach(self, donor: int) -> tuple[np.ndarray, np.ndarray]:
        """Per size p: the largest sum that can take the place of an item of size p in
        a bin at least as full as the donor, and that item. p = 0: a plain move; its
        entry names the bin instead."""
        room = np.where((self.fill >= self.fill[donor]) & (self.fill > 0), self.cap - self.fill, 0)
        room[donor] = 0
        has = room[self.of]
        usable = np.flatnonzero(has)
        order = usable[np.argsort(has[usable], kind="stable")]
        best, item = np.zeros(self.cap + 1, np.int64), np.full(self.cap + 1, -1, np.int64)
        best[self.sizes[order]] = self.sizes[order] + has[order]  # the last write is the largest
        item[self.sizes[order]] = order
        widest = int(room.argmax())
        best[0], item[0] = room[widest], widest
        return best, item

    def give(self, donor: int) -> bool:
        """One improving move, 1-1 or 2-1 exchange out of ``donor``; False if none is left."""
        mine = np.flatnonzero(self.of == donor)
        best, item = self.reach(donor)
        by_size: dict[int, list[int]] = {}
        for i in mine.tolist():
            by_size.setdefault(int(self.sizes[i]), []).append(i)
        singles = {s: [ids[0]] for s, ids in by_size.items()}
        pairs = {
            s + t: [by_size[s][0], by_size[t][0 if s != t else 1]]
            for s in by_size for t in by_size if s <= t and s + t <= self.cap and (s != t or len(by_size[s]) > 1)
        }
        for offers in (singles, pairs):
            top, chosen = 0, None
            for q in sorted(offers, reverse=True):
                if q <= top:
                    break
                able = best[:q] >= q
                p = int(able.argmax())
                if able[p] and q - p > top:
                    top, chosen = q - p, (offers[q], p)
            if chosen is not None:
                items, p = chosen
                if p == 0:
                    self.shift(items, int(item[0]), None)
                else:
                    self.shift(items, int(self.of[item[p]]), int(item[p]))
                return True
        return False

    def search(self, donors: int) -> None:
        """Empty bins, emptiest first, until the lower bound or no exchange helps."""
        goal = self.lower_bound()
        improved = True
        while improved and self.used() > goal:
            improved = False
            live = np.flatnonzero(self.fill > 0)
            live = live[np.argsort(self.fill[live], kind="stable")]
            for donor in live[: donors * (self.used() - goal) + 1].tolist():
                while self.fill[donor] > 0 and self.give(donor):
                    improved = True
                if self.used() <= goal:
                    return


def pack_group(sizes: np.ndarray, cap: int, donors: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every item."""
    packing = Packing(sizes, cap, best_fit(sizes, cap))
    packing.search(donors)
    order = np.lexsort((np.arange(len(sizes)), packing.of))
    ends = np.cumsum(sizes[order])
    bins = packing.of[order]
    first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
    base = np.repeat(ends[first] - sizes[order][first], np.diff(np.r_[first, len(order)]))
    offsets = np.empty(len(sizes), np.int64)
    offsets[order] = ends - sizes[order] - base
    return packing.of, offsets


# ---- Spark side

def pack(pieces: DataFrame, p: PackParams, rows: int) -> DataFrame:
    """Adds sequence_id, offset and fill to (…, length) rows."""
    groups = max(1, math.ceil(rows / p.group))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = [f for f in frames if len(f)]
        if whole:
            df = pd.concat(whole, ignore_index=True)
            sizes = df["length"].to_numpy(np.int64)
            bins, offsets = pack_group(sizes, p.size, p.donors)
            df["sequence_id"] = bins + (TaskContext.get().partitionId() << 20)
            df["offset"] = offsets
            df["fill"] = np.bincount(bins, weights=sizes)[bins].astype(np.int64)
            yield df

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return pieces.repartition(groups).mapInPandas(run, f"{schema}, sequence_id long, offset long, fill long")


def pack_documents(docs: DataFrame, p: PackParams, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) for all documents.

    Rounds: whatever lies in bins that a group could not fill to 97 % is packed
    again in groups of such pieces, until one group holds them all or a round
    saves no sequence.
    """
    seen = Observation()
    parts = cut(pieces_of(docs, p, id_col, text_col), "pack-pieces", seen, F.count("*").alias("n"))
    n, level, done, last = seen.get["n"], 0, [], None
    columns = [*parts.columns, "sequence_id", "offset"]
    while True:
        seen = Observation()
        loose = F.col("fill") < int(p.size * 0.97)
        packed = cut(
            pack(parts, p, n).withColumn("sequence_id", F.col("sequence_id") + (level << 56)), "pack-bins", seen,
            F.count(F.when(loose, 1)).alias("n"), F.count(F.when(loose & (F.col("offset") == 0), 1)).alias("bins"),
        )
        left, bins = seen.get["n"], seen.get["bins"]
        if n <= p.group or left == 0 or (last is not None and bins >= last):
            done.append(packed.select(*columns))
            break
        done.append(packed.filter(~loose).select(*columns))
        parts, n, level, last = packed.filter(loose).select(*parts.columns), left, level + 1, bins
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out
