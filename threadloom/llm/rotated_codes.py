"""Nearest neighbours through randomly rotated one-bit codes.

The index keeps, for every vector, the signs of its randomly rotated, centred
direction (one bit per dimension, packed) and two scalars: its distance from the
centre and the inner product of direction and code. From these and a query's
8-bit rotated coordinates, bit counts give an estimate of each distance and a
bound on its error; only vectors whose lower bound does not exceed the k-th best
distance so far are compared exactly, in double precision.

Every query meets every code, in blocks: queries go to the tasks in passes of
PASS_BYTES at most, each pass reads the stored index once, and each task returns
its k best per query. The index has every row; centre and rotation need no fit
on a sample.

Defined cases: vectors that are NULL, zero, or hold NULL or non-finite
components take no part, nor do rows with a NULL id. Rows with the query's own
id are no candidates. Repeated ids: the query is asked once (with the vector
that sorts first), candidates come as often as they repeat. Vectors of another
width than the query's are no candidates. Ties go to the smaller id. An empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.lineage import cut, fresh_path

PASS_BYTES = 32 << 20
ROWS, ASKED = 2048, 256  # block of codes, block of queries


@dataclass(frozen=True)
class CodeParams:
    """``k``: neighbours. ``epsilon``: width of the error bound in units of the standard
    deviation; recall grows with it, and so does the number of exact comparisons."""

    k: int = 10
    epsilon: float = 2.6
    seed: int = 7


def rotation(width: int, seed: int) -> np.ndarray:
    """Random orthogonal matrix over the width rounded up to whole words of 64 bits."""
    n = -(-width // 64) * 64
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((n, n)))
    return (q * np.sign(np.diag(r)))[:width]


def encode(x: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, distance from the centre, and inner product of direction and code."""
    rest = x - centre
    norm = np.sqrt((rest * rest).sum(axis=1))
    y = (rest / np.where(norm > 0, norm, 1.0)[:, None]) @ turn
    return np.packbits(y > 0, axis=1, bitorder="little"), norm, np.abs(y).sum(axis=1) / math.sqrt(turn.shape[1])


class Asked:
    """A block of queries: rotated, and cut into 8 bit planes."""

    def __init__(self, q: np.ndarray, centre: np.ndarray, turn: np.ndarray, epsilon: float):
        rest = q - centre
        self.norm = np.sqrt((rest * rest).sum(axis=1))
        y = (rest / np.where(self.norm > 0, self.norm, 1.0)[:, None]) @ turn
        self.n = turn.shape[1]
        self.low = y.min(axis=1)
        self.step = np.maximum((y.max(axis=1) - self.low) / 255, 1e-12)
        whole = np.round((y - self.low[:, None]) / self.step[:, None]).astype(np.uint8)
        self.planes = [np.packbits(whole >> b & 1, axis=1, bitorder="little").view("<u8") for b in range(8)]
        self.total = whole.sum(axis=1, dtype=np.int64)
        self.epsilon = epsilon

    def bounds(self, codes: np.ndarray, norm: np.ndarray, product: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the squared distances, queries x codes."""
        words = codes.view("<u8")
        common = np.zeros((len(self.norm), len(words)), np.int64)
        for b, plane in enumerate(self.planes):
            for w in range(words.shape[1]):
                common += np.bitwise_count(plane[:, w, None] & words[None, :, w]).astype(np.int64) << b
        ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
        root = math.sqrt(self.n)
        with_code = (
            2 * self.step[:, None] * common + 2 * self.low[:, None] * ones - (self.step * self.total)[:, None]
        ) / root - root * self.low[:, None]
        good = np.maximum(product, 1e-9)
        # The code's own error is random with this deviation; that of 8-bit rounding is certain.
        spread = self.epsilon * np.sqrt(np.maximum(1 - good * good, 0)) / good / math.sqrt(self.n - 1)
        error = spread[None, :] + self.step[:, None] * root / 2 / good[None, :]
        scale = 2 * self.norm[:, None] * norm[None, :]
        middle = self.norm[:, None] ** 2 + norm[None, :] ** 2 - scale * with_code / good[None, :]
        slack = scale * error + 1e-9 * (1 + np.abs(middle))
        return middle - slack, middle + slack


class Best:
    """The k nearest so far of each query."""

    def __init__(self, asked: int, k: int):
        self.k = k
        self.distance = np.full((asked, k), np.inf)
        self.id = np.full((asked, k), np.iinfo(np.int64).max)

    def add(self, query: np.ndarray, distance: np.ndarray, ids: np.ndarray) -> None:
        touched = np.unique(query)
        q = np.concatenate([np.repeat(touched, self.k), query])
        d = np.concatenate([self.distance[touched].ravel(), distance])
        i = np.concatenate([self.id[touched].ravel(), ids])
        order = np.lexsort((i, d, q))
        q, d, i = q[order], d[order], i[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = place < self.k
        self.distance[q[keep], place[keep]] = d[keep]
        self.id[q[keep], place[keep]] = i[keep]


def euclidean(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = a - b
    return np.sqrt((gap * gap).sum(axis=1))


# ---- Spark side

def usable(vector: Column) -> Column:
    """True for vectors that can take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def build_index(vectors: DataFrame, centre: np.ndarray, turn: np.ndarray) -> DataFrame:
    """(id, vector) with code, norm and product added, stored."""
    width = len(centre)
    kind = vectors.schema["vector"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, norm, product = encode(_matrix(batch.column(1), width), centre, turn)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([c.tobytes() for c in code], pa.binary()), pa.array(norm), pa.array(product)],
                names=["id", "vector", "code", "norm", "product"],
            )

    return cut(vectors.mapInArrow(run, f"id long, vector {kind}, code binary, norm double, product double"), "codes")


def corpus_centre(vectors: DataFrame, width: int) -> np.ndarray:
    """Mean of all vectors; one row per dimension reaches the driver."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(width), 0
        for batch in batches:
            total += _matrix(batch.column(0), width).sum(axis=0)
            n += len(batch)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total), pa.array(np.full(width, n))], names=["at", "s", "n"])

    rows = (
        vectors.select("vector").mapInArrow(sums, "at long, s double, n long")
        .groupBy("at").agg((F.sum("s") / F.sum("n")).alias("mean")).orderBy("at").collect()
    )
    return np.array([r["mean"] for r in rows])


def search(index: DataFrame, shared: Broadcast, centre: np.ndarray, turn: np.ndarray, p: CodeParams) -> DataFrame:
    """The k nearest of one pass of queries (ids and vectors), per task of the index."""
    width = len(centre)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, asked = shared.value
        blocks = [(a, Asked(asked[a:a + ASKED], centre, turn, p.epsilon)) for a in range(0, len(ids), ASKED)]
        best = Best(len(ids), p.k)
        for whole in batches:
            for batch in (whole.slice(i, ROWS) for i in range(0, len(whole), ROWS)):
                own = batch.column(0).to_numpy()
                x = _matrix(batch.column(1), width)
                code = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(len(x), -1)
                norm, product = batch.column(3).to_numpy(), batch.column(4).to_numpy()
                for a, block in blocks:
                    low, high = block.bounds(code, norm, product)
                    mine = ids[a:a + ASKED, None] == own[None, :]
                    low[mine] = high[mine] = np.inf
                    reach = best.distance[a:a + ASKED, -1] ** 2
                    if len(x) >= p.k:
                        reach = np.minimum(reach, np.partition(high, p.k - 1, axis=1)[:, p.k - 1])
                    q, v = np.nonzero((low <= reach[:, None] * (1 + 1e-12)) & (low < np.inf))
                    for i in range(0, len(q), 1 << 16):
                        qi, vi = q[i:i + (1 << 16)], v[i:i + (1 << 16)]
                        best.add(a + qi, euclidean(asked[a + qi], x[vi]), own[vi])
        q, r = np.nonzero(best.distance < np.inf)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[q]), pa.array(best.id[q, r]), pa.array(best.distance[q, r])], names=["query_id", "id", "score"]
        )

    return index.mapInArrow(run, "query_id long, id long, score double")


def nearest(
    vectors: DataFrame, is_query: Column, p: CodeParams | None = None, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, id, score): the k nearest rows of every row for which ``is_query`` holds."""
    p, spark = p or CodeParams(), vectors.sparkSession
    rows = vectors.filter(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")
    )
    widths = sorted(r.w for r in rows.filter("asks").select(F.size("vector").alias("w")).distinct().collect())
    path = fresh_path(spark, "nearest")
    spark.createDataFrame([], "query_id long, id long, score double").write.parquet(path)
    for width in widths:
        same = rows.filter(F.size("vector") == width)
        centre, turn = corpus_centre(same, width), rotation(width, p.seed)
        index = build_index(same.select("id", "vector"), centre, turn)
        asks = same.filter("asks").groupBy("id").agg(F.min("vector").alias("vector"))
        asks = cut(asks, "asked")
        passes = math.ceil(2 * asks.count() * width * 8 / PASS_BYTES)
        for k in range(passes):
            # Half full on average, so that uneven hashing stays below the limit.
            part = asks.filter(F.pmod(F.xxhash64("id"), F.lit(passes)) == k).orderBy("id").toArrow().combine_chunks()
            if len(part):
                asked = np.array(part.column("vector").to_pylist(), np.float64)
                shared = spark.sparkContext.broadcast((part.column("id").to_numpy(), asked))  # PASS_BYTES at most
                search(index, shared, centre, turn, p).write.mode("append").parquet(path)
                shared.destroy()
    order = Window.partitionBy("query_id").orderBy("score", "id")
    found = spark.read.schema("query_id long, id long, score double").parquet(path)
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= p.k).select(
        "query_id", "rank", F.col("id").alias(id_col), "score"
    )
