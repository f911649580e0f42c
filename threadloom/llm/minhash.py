"""Near-duplicate documents by b-bit MinHash.

1. A document is the set of its word shingles, hashed to 64 bits. Equal sets are
   one class. The minima of HASHES hash functions are taken over the set; of each
   only BITS low bits are kept, packed into the class's signature. Bands of ROWS
   full minima give BANDS bucket keys.
2. Classes that share a bucket are candidates. Equal signature fields, corrected
   for chance collisions, estimate the similarity; pairs that could reach the
   threshold tie their classes into families (one tree per bucket leaves the
   bucket, never all its pairs).
3. Within a family, links are confirmed on full sets, made again from the texts.
   A pair already connected by confirmed links needs no test.
4. Connected components of the confirmed links.

Families and buckets above BLOCK members are split: first every block by itself,
then only members outside the group's largest part meet all other blocks.

A pair at the threshold of 0.8 shares no band with probability 5e-8
((1 - 0.8**4)**32) and falls short of the signature limit with less than 1e-6.

Defined cases: NULL text and text without words have an empty set, which links
with nothing. Repeated rows are one class and all get its component. Rows with a
NULL id count as members but name no component; if all members are such, the
component is NULL and nothing is kept. An empty table gives no rows. Only id and
text are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from threadloom.lineage import cut, fresh_path, job
from threadloom.llm.components import components

HASHES, BITS, ROWS, BANDS = 128, 4, 4, 32
BUCKET_BLOCK, FAMILY_BLOCK = 2048, 384
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_RNG = np.random.default_rng(20240229)
_A = _RNG.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 2**63, HASHES, dtype=np.uint64)
_PLACE = _RNG.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass(frozen=True)
class NearParams:
    """``words`` in a shingle; linked if common * 100 >= ``percent`` * union."""

    words: int = 5
    percent: int = 80

    def least_fields(self) -> int:
        """Equal signature fields that a linked pair has, but for 1 in a million."""
        chance = 1 / 2**BITS
        p = self.percent / 100 * (1 - chance) + chance
        tail, m = 0.0, 0
        while True:
            tail += math.comb(HASHES, m) * p**m * (1 - p) ** (HASHES - m)
            if tail > 1e-6:
                return m
            m += 1


# ---- sets and signatures

def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Shingler:
    """Shingle sets of texts; remembers word hashes."""

    def __init__(self, words: int, keep: int = 500_000):
        self.words, self.keep, self.known = words, keep, {}

    def word_hashes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            if len(known) > self.keep:
                known.clear()
            known.update((w, xxhash.xxh64_intdigest(w)) for w in set(words) if w not in known)
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes of the shingles of A-Z lower-cased words."""
        h = self.word_hashes((text or "").encode().translate(_LOWER).split())
        n = min(self.words, len(h))
        if n == 0:
            return np.empty(0, np.uint64)
        total = np.full(len(h) - n + 1, n, np.uint64)
        for k in range(n):
            total = _mix(total * _PLACE[k % 64] + h[k:len(h) - n + 1 + k])
        return np.unique(total)


def minima(shingles: np.ndarray) -> np.ndarray:
    """Smallest value of each hash function over the set."""
    low = np.full(HASHES, 2**64 - 1, np.uint64)
    for i in range(0, len(shingles), 256):
        block = shingles[i:i + 256, None] * _A
        block += _B
        # High bits of a product are the good ones: bring them down first.
        np.minimum(low, (block ^ (block >> np.uint64(29))).min(axis=0), out=low)
    return low


def signature(low: np.ndarray) -> bytes:
    """Low bits of all minima, two fields to a byte."""
    field = (_mix(low) & np.uint64(2**BITS - 1)).astype(np.uint8)
    return (field[0::2] << 4 | field[1::2]).tobytes()


def band_keys(low: np.ndarray) -> np.ndarray:
    keys = np.arange(BANDS, dtype=np.uint64)
    for column in low.reshape(BANDS, ROWS).T:
        keys = _mix(keys * _PLACE[0] + column)
    return keys.view(np.int64)


def equal_fields(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal fields of each signature of ``a`` with each of ``b`` (rows of 64-bit words)."""
    unequal = np.zeros((len(a), len(b)), np.int64)
    ones = np.uint64(0x1111111111111111)
    for w in range(a.shape[1]):
        x = a[:, w, None] ^ b[None, :, w]
        x |= x >> np.uint64(2)
        x |= x >> np.uint64(1)
        unequal += np.bitwise_count(x & ones)
    return HASHES - unequal


def similarity(equal: np.ndarray) -> np.ndarray:
    """Estimated similarity, corrected for fields that are equal by chance."""
    chance = 1 / 2**BITS
    return (equal / HASHES - chance) / (1 - chance)


def candidates(codes_a, sizes_a, codes_b, sizes_b, p: NearParams) -> np.ndarray:
    """Pairs that can be linked, by signatures and set sizes."""
    small, large = np.minimum(sizes_a[:, None], sizes_b), np.maximum(sizes_a[:, None], sizes_b)
    return (equal_fields(codes_a, codes_b) >= p.least_fields()) & (100 * small >= p.percent * large)


def is_linked(a: np.ndarray, b: np.ndarray, p: NearParams) -> bool:
    """Exact test on sorted sets."""
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return common > 0 and 100 * common >= p.percent * (len(both) - common)


# ---- trees over a run of members

def tree_by_signature(side: np.ndarray, codes: np.ndarray, sizes: np.ndarray, labels: np.ndarray, p: NearParams) -> list[tuple[int, int]]:
    """Stars over whatever candidate pairs connect; each member is looked at once."""
    edges, waiting = [], np.ones(len(codes), bool)
    for start in range(len(codes)):
        if not waiting[start]:
            continue
        waiting[start] = False
        front = [start]
        while front:
            i = front.pop()
            rest = np.flatnonzero(waiting)
            if not len(rest):
                break
            near = rest[candidates(codes[i:i + 1], sizes[i:i + 1], codes[rest], sizes[rest], p)[0]]
            waiting[near] = False
            edges += [(start, j) for j in near.tolist()]
            front += near.tolist()
    return edges


def tree_by_sets(side: np.ndarray, codes: np.ndarray, sizes: np.ndarray, labels: np.ndarray, p: NearParams, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Stars over whatever confirmed links connect."""
    parent = list(range(len(sets)))
    first: dict[bytes, int] = {}
    for i, label in enumerate(labels):  # members of one part are connected already
        if label is not None:
            parent[i] = first.setdefault(label, i)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in np.flatnonzero(candidates(codes[i:i + 1], sizes[i:i + 1], codes[i + 1:], sizes[i + 1:], p)[0]).tolist():
            j += i + 1
            if side[i] == side[j] == 1:
                continue  # the block of the others by itself is done
            a, b = root(i), root(j)
            if a != b and is_linked(sets[i], sets[j], p):
                parent[b] = a
    return [(root(i), i) for i in range(len(sets)) if root(i) != i]


FIELDS = ["group", "part", "side", "id", "label", "size", "code"]


def edges_of_runs(members: DataFrame, p: NearParams, exact: bool, tasks: int) -> DataFrame:
    """Trees of all (group, part) runs of members.

    Rows: group, part, side, id, label, size, code, and text if ``exact``. Runs are
    of bounded length; a task holds one run and one Arrow batch at a time.
    """

    def run_edges(rows: list[tuple], shingles: Shingler) -> Iterator[tuple[bytes, bytes]]:
        found: dict[bytes, tuple] = {}
        for r in rows:
            if r[3] in found:
                continue  # a row of the other side, or a repeated text
            extra = shingles(r[7]) if exact else None
            if not exact or set_id(extra) == r[3]:
                found[r[3]] = (r, extra)
        rows = [r for r, _ in found.values()]
        if len(rows) < 2:
            return
        codes = np.frombuffer(b"".join(r[6] for r in rows), "<u8").reshape(len(rows), -1)
        side, sizes = np.array([r[2] for r in rows]), np.array([r[5] for r in rows], np.int64)
        labels = [r[4] for r in rows]
        if exact:
            edges = tree_by_sets(side, codes, sizes, labels, p, [x for _, x in found.values()])
        else:
            edges = tree_by_signature(side, codes, sizes, labels, p)
        for i, j in edges:
            yield rows[i][3], rows[j][3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(p.words)
        held: list[tuple] = []

        def out(edges: list) -> pa.RecordBatch:
            columns = list(zip(*edges)) or [(), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=["a", "b"])

        for whole in batches:
            for batch in (whole.slice(i, 1024) for i in range(0, len(whole), 1024)):
                edges = []
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    if held and held[0][:2] != row[:2]:
                        edges += run_edges(held, shingles)
                        held = []
                    held.append(row)
                yield out(edges)
        yield out(list(run_edges(held, shingles)) if held else [])

    columns = FIELDS + (["text"] if exact else [])
    dealt = members.select(*columns).repartition(tasks, "group", "part").sortWithinPartitions("group", "part", "side", "id")
    return dealt.mapInArrow(run, "a binary, b binary")


def connected(members: DataFrame, p: NearParams, exact: bool, block: int) -> DataFrame:
    """Edges (a, b) that connect the members of each group as their links do.

    Groups up to ``block`` members are one run. Larger ones first run block by
    block; then members outside the group's largest part so far meet every block.
    """
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = members.withColumn("side", F.lit(0)).withColumn("label", F.lit(None).cast("binary"))
    seen = Observation()
    sizes = cut(
        members.groupBy("group").agg(F.count("*").alias("n")).filter(F.col("n") > block), "large-groups", seen, F.count("*").alias("n"),
    )
    if seen.get["n"] == 0:
        return cut(edges_of_runs(plain.withColumn("part", F.lit("")), p, exact, tasks), "links")
    parts = sizes.select("group", F.ceil(F.col("n") / block).cast("int").alias("parts"))
    plain = plain.join(parts, "group", "left").withColumn(
        "own", F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("id"), F.col("parts")))
    )
    first = cut(edges_of_runs(plain.withColumn("part", F.coalesce(F.col("own").cast("string"), F.lit(""))), p, exact, tasks), "links")
    labels = components(first).withColumnRenamed("label", "found")
    large = plain.filter("parts IS NOT NULL").join(labels, "id", "left").withColumn("label", F.coalesce("found", "id")).drop("found")
    counts = large.groupBy("group", "label").agg(F.count("*").alias("n"))
    main = counts.groupBy("group").agg(F.max_by("label", F.struct("n", "label")).alias("main"))
    rest = counts.join(main, "group").filter("label <> main").groupBy("group").agg(F.sum("n").alias("r"))
    rest = rest.select("group", F.ceil(F.col("r") / block).cast("int").alias("others"))
    large = large.join(main, "group").join(rest, "group")
    asks = large.filter("label <> main").withColumn("k", F.pmod(F.xxhash64("id", F.lit(1)), F.col("others"))).withColumn("side", F.lit(0))
    asks = asks.withColumn("m", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("parts") - 1).cast("long"))))
    all_ = large.withColumn("side", F.lit(1)).withColumn("m", F.col("own").cast("long"))
    all_ = all_.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("others") - 1).cast("long"))))
    columns = [c for c in FIELDS + (["text"] if exact else []) if c != "part"] + ["k", "m"]
    second = asks.select(*columns).union(all_.select(*columns)).withColumn("part", F.concat_ws("x", "k", "m"))
    return first.union(cut(edges_of_runs(second, p, exact, tasks), "links"))


# ---- Spark side

def set_id(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def signatures(docs: DataFrame, p: NearParams, id_col: str, text_col: str) -> DataFrame:
    """(id, near, n_shingles, set, bands, code) per document, stored. ``near`` finds the text again."""
    docs = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text_col)).alias("near"), F.col(text_col).alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(p.words)
        for whole in batches:
            for batch in (whole.slice(i, 512) for i in range(0, len(whole), 512)):
                rows = []
                for text in batch.column(2):
                    found = shingles(text.as_py())
                    low = minima(found) if len(found) else None
                    rows.append((len(found), set_id(found), band_keys(low) if len(found) else None, signature(low) if len(found) else None))
                n, sets, bands, codes = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(sets, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(codes, pa.binary())],
                    names=["id", "near", "n_shingles", "set", "bands", "code"],
                )

    return cut(docs.mapInArrow(run, "id long, near long, n_shingles long, set binary, bands array<long>, code binary"), "signatures")


def near_duplicates(docs: DataFrame, p: NearParams | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) per document; component_id is the smallest id reachable."""
    p = p or NearParams()
    rows = signatures(docs, p, id_col, text_col)
    classes = rows.filter("set IS NOT NULL").groupBy("set").agg(
        F.min("id").alias("least"), F.min("near").alias("near"), F.first("n_shingles").alias("size"), F.first("code").alias("code"), F.first("bands").alias("bands")
    )
    classes = cut(classes, "classes")
    path = fresh_path(docs.sparkSession, "linked")
    with job(docs.sparkSession):  # buckets, families and rounds go when the links are written
        linked_classes(docs, classes, p, id_col, text_col).write.parquet(path)
    linked = docs.sparkSession.read.schema("id binary, label binary").parquet(path)
    named = classes.select("set", "least").join(linked.withColumnRenamed("id", "set"), "set", "left").withColumn("label", F.coalesce("label", "set"))
    names = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = named.join(names, "label").select("set", "component_id")
    found = rows.select("id", "n_shingles", "set").join(named, "set", "left")
    component = F.when(F.col("set").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return found.select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


def linked_classes(docs: DataFrame, classes: DataFrame, p: NearParams, id_col: str, text_col: str) -> DataFrame:
    """(id, label) of the classes that have confirmed links."""
    banded = classes.select(F.explode("bands").alias("group"), F.col("set").alias("id"))
    shared = banded.groupBy("group").agg(F.count("*").alias("n")).filter("n > 1").select("group")
    banded = cut(banded.join(shared, "group"), "buckets")
    signed = banded.join(classes.select(F.col("set").alias("id"), "size", "code"), "id")
    families = components(connected(signed, p, exact=False, block=BUCKET_BLOCK)).withColumnRenamed("label", "group")
    texts = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text_col)).alias("near"), F.col(text_col).alias("text")
    )
    members = families.join(classes.select(F.col("set").alias("id"), "near", "size", "code"), "id").join(texts, "near").drop("near")
    return components(connected(cut(members, "families"), p, exact=True, block=FAMILY_BLOCK))
