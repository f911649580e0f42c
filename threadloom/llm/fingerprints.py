"""Document fingerprints from improbable byte windows.

Every window of WINDOW bytes has an entropy level. How rare each level is in the
corpus, over all windows of all documents, gives a rank. Of each run of SPAN
neighbouring windows the rarest (leftmost on ties) gets a point, and windows
with POINTS or more points are the document's features. Features enter a chain
of Bloom filters, a new one after PER_FILTER features. Two fingerprints compare
by the best normalised bit overlap of each filter of the smaller one.

Defined cases: NULL text is empty. A text shorter than a window is a feature as
a whole; an empty text has none and an empty fingerprint. Two empty fingerprints
have likeness 1, an empty and another one 0. Documents stand in descending order
of id, NULL ids last, equal ids by text; the first follows the last, so a single
document follows itself. An empty table gives no rows. Columns other than id and
text are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import shuffle_tasks

WINDOW, SPAN, POINTS = 32, 64, 12
LEVELS = 1000
BITS, PER_FILTER, PROBES = 2048, 160, 5
CHUNK = 1 << 18  # bytes handled in one go
STREAM = 256  # rows taken from an Arrow batch at a time
DULL = np.int64(LEVELS + 1)  # rank of what is no window

# Entropy of a window = log2(WINDOW) - (sum of c * log2 c) / WINDOW, kept in whole numbers.
_SCALE = 1 << 16
_COUNTS = np.arange(WINDOW + 2, dtype=np.float64)
_TERM = np.round(_SCALE * _COUNTS * np.log2(np.maximum(_COUNTS, 1))).astype(np.int64)
_STEP = np.diff(_TERM)  # from c to c + 1


def entropy_levels(data: np.ndarray) -> np.ndarray:
    """Level 0 to LEVELS of the window that starts at each position."""
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.int64)
    behind, ahead = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    for lag in range(1, WINDOW + 1):
        same = (data[lag:] == data[:-lag]).view(np.uint8)
        ahead[: len(data) - lag] += same
        if lag < WINDOW:
            behind[lag:] += same
    first = int(_TERM[np.bincount(data[:WINDOW])].sum())
    # A step drops the first byte of the old window and adds one at the end. `ahead`
    # of the dropped byte counts the new one too, hence is its count in both together.
    gone = ahead[: n - 1].astype(np.int64)
    new = data[WINDOW:] == data[: n - 1]
    came = behind[WINDOW:].astype(np.int64)  # in the WINDOW - 1 bytes that stay
    total = np.empty(n, np.int64)
    total[0] = first
    np.cumsum(_STEP[came] - _STEP[gone - new], out=total[1:])
    total[1:] += first
    top = _SCALE * WINDOW * np.log2(WINDOW)
    return np.round((1 - total / top) * LEVELS).astype(np.int64).clip(0, LEVELS)


def _runs(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) + SPAN + WINDOW
        if size > CHUNK:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts with gaps that no span bridges, where each starts, and which windows are whole."""
    starts = SPAN + np.cumsum([0] + [len(t) + SPAN + WINDOW for t in texts])
    data = np.zeros(int(starts[-1]), np.uint8)
    whole = np.zeros(len(data), bool)
    for t, at in zip(texts, starts.tolist()):
        data[at:at + len(t)] = np.frombuffer(t, np.uint8)
        whole[at:at + max(0, len(t) - WINDOW + 1)] = True
    return data, starts, whole[: max(0, len(data) - WINDOW + 1)]


def level_counts(texts: list[bytes]) -> np.ndarray:
    """How many windows have each level."""
    counts = np.zeros(LEVELS + 1, np.int64)
    for a, b in _runs(texts):
        data, _, whole = _joined(texts[a:b])
        counts += np.bincount(entropy_levels(data)[whole], minlength=LEVELS + 1)
    return counts


def ranks_of(counts: np.ndarray) -> np.ndarray:
    """Rank of each level: the rarest first, ties by level."""
    ranks = np.empty(LEVELS + 1, np.int64)
    ranks[np.argsort(counts, kind="stable")] = np.arange(LEVELS + 1)
    return ranks


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def feature_hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit hashes of the windows that start at ``at``."""
    blocks = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[at]
    h = np.full(len(at), 0x9E3779B97F4A7C15, np.uint64)
    for word in np.ascontiguousarray(blocks).view("<u8").T:
        h = _mix(h ^ word)
    return h


def digests(texts: list[bytes], ranks: np.ndarray) -> list[bytes]:
    """Fingerprint of each text: its Bloom filters one after the other."""
    out: list[bytes] = []
    for a, b in _runs(texts):
        data, starts, whole = _joined(texts[a:b])
        rank = np.where(whole, ranks[entropy_levels(data)], DULL) if len(whole) else np.empty(0, np.int64)
        # Smallest (rank, position) of every span, by doubling.
        low = (rank << np.int64(32)) | np.arange(len(rank), dtype=np.int64)
        width = 1
        while width < SPAN and len(low) > width:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        turn = np.flatnonzero(np.r_[True, low[1:] != low[:-1]]) if len(low) else np.empty(0, np.int64)
        points = np.diff(np.r_[turn, len(low)])
        chosen = low[turn]
        good = (points >= POINTS) & (chosen >> np.int64(32) < DULL)
        at = chosen[good] & np.int64(0xFFFFFFFF)
        hashes = feature_hashes(data, at)
        edges = np.searchsorted(at, starts)
        for k, text in enumerate(texts[a:b]):
            own = hashes[edges[k]:edges[k + 1]]
            if not len(own) and text:
                # Too short for a span: its first window, or all of it.
                padded = np.frombuffer(text[:WINDOW].ljust(WINDOW, b"\0") if len(text) < WINDOW else text, np.uint8)
                own = feature_hashes(padded, np.array([0]))
            out.append(bloom_chain(own))
    return out


def bloom_chain(hashes: np.ndarray) -> bytes:
    first = np.sort(np.unique(hashes, return_index=True)[1])
    hashes = hashes[first]
    filters = np.zeros((-(-len(hashes) // PER_FILTER), BITS), np.uint8)
    chain = np.arange(len(hashes)) // PER_FILTER
    for k in range(PROBES):
        filters[chain, ((hashes >> np.uint64(11 * k)) % np.uint64(BITS)).astype(np.int64)] = 1
    return np.packbits(filters, axis=1).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Overlap of two fingerprints: 0 at what chance gives, 1 where one holds the other."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    x, y = (np.frombuffer(v, np.uint8).reshape(-1, BITS // 8) for v in (a, b))
    nx, ny = (np.bitwise_count(v).sum(axis=1, dtype=np.int64) for v in (x, y))
    if nx.sum() > ny.sum():
        x, y, nx, ny = y, x, ny, nx
    total = 0.0
    for row, n in zip(x, nx):
        both = np.bitwise_count(row & y).sum(axis=1, dtype=np.int64)
        chance = n * ny / BITS
        room = np.minimum(n, ny) - chance
        total += n * float(np.max(np.where(room > 0, (both - chance) / np.maximum(room, 1e-9), 0.0)).clip(0.0, 1.0))
    return total / float(nx.sum())


# ---- Spark side

def corpus_ranks(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Rarity ranks of the entropy levels over all windows of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(LEVELS + 1, np.int64)
        for batch in batches:
            for at in range(0, len(batch), STREAM):
                counts += level_counts([(t.as_py() or "").encode() for t in batch.column(0).slice(at, STREAM)])
        level = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(level), pa.array(counts[level])], names=["level", "n"])

    # At most LEVELS + 1 rows reach the driver, whatever the corpus.
    rows = docs.select(text_col).mapInArrow(count, "level long, n long").groupBy("level").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(LEVELS + 1, np.int64)
    for r in rows:
        counts[r.level] = r.n
    return ranks_of(counts)


def in_order(docs: DataFrame, id_col: str, text_col: str, tasks: int) -> DataFrame:
    """(id, text, bucket, extra): ranges of ids, each followed by the first rows of the next.

    Range limits are quantiles of the ids, so buckets are even. One number per
    bucket passes the driver.
    """
    key = F.col(id_col).cast("long")
    docs = docs.select(key.alias("id"), F.col(text_col).alias("text"))
    limits = docs.select(F.percentile_approx("id", [i / tasks for i in range(1, tasks)] or [0.5], F.lit(10000))).first()[0] or []
    limits = sorted(set(limits[: tasks - 1]), reverse=True) if tasks > 1 else []
    at = F.array(*[F.lit(x) for x in limits]) if limits else F.array().cast("array<long>")
    # Bucket 0 has the largest ids; NULL ids come last.
    bucket = F.when(F.col("id").isNull(), len(limits)).otherwise(F.size(F.filter(at, lambda x: x >= F.col("id"))))
    placed = docs.withColumn("bucket", bucket)
    heads = placed.groupBy("bucket").agg(F.max("id").alias("head")).orderBy("bucket").collect()
    head, previous = [None] * (len(limits) + 1), [0] * (len(limits) + 1)
    for i, r in enumerate(heads):  # the first follows the last
        head[r.bucket], previous[r.bucket] = r.head, heads[i - 1].bucket
    place = (F.col("bucket") + 1).cast("int")
    is_head = F.col("id").eqNullSafe(F.element_at(F.array(*[F.lit(x).cast("long") for x in head]), place))
    previous = F.element_at(F.array(*[F.lit(x) for x in previous]), place)
    copies = F.when(
        is_head,
        F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("extra")),
                F.struct(previous.alias("bucket"), F.lit(True).alias("extra"))),
    ).otherwise(F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("extra"))))
    return (
        placed.select("id", "text", F.inline(copies))
        .repartition(tasks, "bucket")
        .sortWithinPartitions("bucket", "extra", F.col("id").desc_nulls_last(), F.col("text").asc_nulls_first())
    )


OUT = [
    ("n_chars", pa.int64(), "long"), ("edited_sha256", pa.string(), "string"), ("fingerprint", pa.string(), "string"),
    ("edited_fingerprint", pa.string(), "string"), ("near_edited", pa.float64(), "double"), ("near_next", pa.float64(), "double"),
]


def edited(text: str, following: str) -> str:
    k = len(text) // 2
    return text[: len(text) - k] + following[:k]


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, with both likenesses.

    The edited text has its second half replaced by the start of the next text.
    Each task streams its range of ids in order and holds STREAM texts and one more.
    """
    ranks = corpus_ranks(docs, text_col)
    tasks = shuffle_tasks(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = None  # the last row, whose next one is still to come
        for batch in (b.slice(at, STREAM) for b in batches for at in range(0, len(b), STREAM)):
            rows = [(i, t or "", b, x) for i, t, b, x in zip(*(batch.column(k).to_pylist() for k in range(4)))]
            prints = digests([t.encode() for _, t, _, _ in rows], ranks)
            chain = ([carried] if carried else []) + list(zip(rows, prints))
            pairs = [(a, b) for a, b in zip(chain, chain[1:]) if not a[0][3] and a[0][2] == b[0][2]]
            carried = chain[-1] if chain else None
            changed = [edited(a[0][1], b[0][1]).encode() for a, b in pairs]
            out = []
            for (a, b), text, mark in zip(pairs, changed, digests(changed, ranks)):
                out.append((
                    a[0][0], len(a[0][1]), hashlib.sha256(text).hexdigest(), base64.b64encode(a[1]).decode(),
                    base64.b64encode(mark).decode(), likeness(a[1], mark), likeness(a[1], b[1]),
                ))
            columns = list(zip(*out)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [pa.int64(), *(t for _, t, _ in OUT)])],
                names=["id", *(n for n, _, _ in OUT)],
            )

    schema = "id long, " + ", ".join(f"{n} {s}" for n, _, s in OUT)
    return in_order(docs, id_col, text_col, tasks).mapInArrow(run, schema).withColumnRenamed("id", id_col)
