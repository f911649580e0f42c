"""Embeddings: cosine top-k, exact or over pruned clusters, and storing them.

Rows to search lie in cells of bounded size. Scoring runs inside tasks: a cell is a
matrix in memory, queries pass by it in batches, and k rows per query and cell are
sent on. Queries that are small by their written size travel to the corpus instead,
which is then not shuffled at all. No pairs of vectors are ever rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from threadloom.lineage import cut
from threadloom.operators.models import failed, map_model, succeeded
from threadloom.operators.skew import size_in_bytes
from threadloom.sources.layers import upsert_layer

# Default k, candidates per k, default dimensions.
TOP_K = 3
CANDIDATES_PER_K = 10
DIMENSIONS = 1024

QUERY_BYTES = 16 << 20  # written queries up to this size are broadcast
CELL_BYTES = 64 << 20  # vectors of one cell, as doubles
SCORE_ROWS = 2_048  # corpus rows scored at once
SCORE_QUERIES = 1_024  # queries scored at once
PROBES = 8  # clusters that every query looks at first
DIGITS = 12  # of a score: what is equal to so many digits goes by id


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; NULL when either has no length."""
    def dot(x, y):
        return F.aggregate(
            F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")),
            F.lit(0.0),
            lambda acc, v: acc + v,
        )

    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)


def usable(vector: Column, width: int | None = None) -> Column:
    """Whether a vector has a direction: no missing entries, some length, and ``width`` if given."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)) & F.exists(vector, lambda x: x != 0)
    return F.coalesce(whole if width is None else whole & (F.size(vector) == width), F.lit(False))


def _units(column: pa.Array, width: int) -> np.ndarray:
    """Vectors with a direction as rows of length one; infinite ones become rows of NaN."""
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    with np.errstate(invalid="ignore", over="ignore"):
        return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _best(sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the k best of every row, equal scores by place; -inf is none."""
    sims = np.round(sims, DIGITS)
    sims[np.isnan(sims)] = -np.inf
    n = sims.shape[1]
    if n <= k:
        at = np.argsort(-sims, axis=1, kind="stable")
        return at, np.take_along_axis(sims, at, axis=1)
    at = np.sort(np.argpartition(-sims, k - 1, axis=1)[:, :k], axis=1)
    kth = np.take_along_axis(sims, at, axis=1).min(axis=1)
    # Which of several rows with the k-th score are among the k is up to the partition: take the first.
    for i in np.flatnonzero((sims >= kth[:, None]).sum(axis=1) > k):
        close = np.flatnonzero(sims[i] >= kth[i])
        at[i] = np.sort(close[np.argsort(-sims[i, close], kind="stable")[:k]])
    scores = np.take_along_axis(sims, at, axis=1)
    order = np.argsort(-scores, axis=1, kind="stable")
    return np.take_along_axis(at, order, axis=1), np.take_along_axis(scores, order, axis=1)


class Cell:
    """Rows to search, in order of their ids: units, ids and domains."""

    def __init__(self, ids: list, units: np.ndarray, domains: list | None):
        order = sorted(range(len(ids)), key=lambda i: ids[i])
        self.ids = np.array(ids, dtype=object)[order]
        self.units = units[order]
        self.domains = np.array(domains, dtype=object)[order] if domains is not None else None

    def search(self, units: np.ndarray, domains: list, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first query, places, scores) of the k best rows in each query's domain, for some queries at a time."""
        for at in range(0, len(units), SCORE_QUERIES):
            sims = units[at : at + SCORE_QUERIES] @ self.units.T
            if self.domains is not None:
                asked = np.array(domains[at : at + SCORE_QUERIES], dtype=object)
                for domain in {d for d in asked if d is not None}:
                    sims[np.ix_(asked == domain, self.domains != domain)] = -np.inf
            yield at, *_best(sims, k)


def _rows(found: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    """(query id, ids, scores) as rows."""
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat([q for q, _, _ in found], [len(x) for _, x, _ in found]), pa.int64()),
            pa.array([i for _, ids, _ in found for i in ids], id_type),
            pa.array(np.concatenate([s for _, _, s in found]) if found else [], pa.float64()),
        ],
        names=["query_id", "id", "score"],
    )


def _hits(id_kind: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("query_id", T.LongType()), T.StructField("id", id_kind), T.StructField("score", T.DoubleType()),
    ])


def _search_in_place(corpus: DataFrame, queries: DataFrame, width: int, k: int) -> DataFrame:
    """k best rows per query and task; ``queries`` are small, and the corpus stays where it is."""
    held = queries.toArrow().combine_chunks()  # bounded by QUERY_BYTES on disk
    vectors = held.column("embedding").combine_chunks()
    shared = corpus.sparkSession.sparkContext.broadcast(
        (held.column("query_id").to_pylist(), _units(vectors, width), held.column("l1_domain").to_pylist())
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, units, domains = shared.value
        best: dict[int, tuple[list, list]] = {}
        kth = np.full(len(query_ids), -np.inf)
        kind = pa.string()
        for batch in batches:
            kind = batch.column(0).type
            for start in range(0, batch.num_rows, SCORE_ROWS):
                part = batch.slice(start, SCORE_ROWS)
                cell = Cell(part.column(0).to_pylist(), _units(part.column(1), width), part.column(2).to_pylist())
                for at, places, scores in cell.search(units, domains, k):
                    close = (scores[:, 0] > -np.inf) & (scores[:, 0] >= kth[at : at + len(scores)])
                    for i in np.flatnonzero(close):
                        had, there = best.get(at + i, ((), ())), scores[i] > -np.inf
                        merged = sorted(
                            zip([*had[1], *scores[i][there].tolist()], [*had[0], *cell.ids[places[i][there]]]),
                            key=lambda x: (-x[0], x[1]),
                        )[:k]
                        best[at + i] = [x for _, x in merged], [x for x, _ in merged]
                        if len(merged) == k:
                            kth[at + i] = merged[-1][0]
        found = [(query_ids[j], ids, scores) for j, (ids, scores) in best.items()]
        for at in range(0, len(found), 10_000):
            yield _rows(found[at : at + 10_000], kind)

    return corpus.mapInArrow(run, _hits(corpus.schema["id"].dataType))


def _search_cells(cells: DataFrame, asked: DataFrame, width: int, k: int) -> DataFrame:
    """k best rows per query and cell, for (cell, id, vector, domain) and (cell, query_id, embedding, l1_domain).

    Rows and queries of a cell meet in one partition, rows first: a task holds one
    cell at a time and lets its queries pass.
    """
    none = {c: F.lit(None).cast(cells.schema[c].dataType).alias(c) for c in ("id", "vector", "domain")}
    blank = {c: F.lit(None).cast(asked.schema[c].dataType).alias(c) for c in ("query_id", "embedding", "l1_domain")}
    both = cells.select("cell", F.lit(0).alias("kind"), *none, *blank.values()).unionByName(
        asked.select("cell", F.lit(1).alias("kind"), *none.values(), *blank)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, cell = None, [], None
        for batch in batches:
            where, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = np.flatnonzero((np.diff(where) != 0) | (np.diff(kind) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, len(where)]):
                part = batch.slice(a, b - a)
                if where[a] != at:
                    at, parts, cell = where[a], [], None
                if kind[a] == 0:
                    parts.append((part.column(2).to_pylist(), _units(part.column(3), width), part.column(4).to_pylist()))
                elif parts:
                    if cell is None:
                        cell = Cell(
                            [i for p in parts for i in p[0]], np.concatenate([p[1] for p in parts]), [d for p in parts for d in p[2]]
                        )
                    ids = part.column(5).to_pylist()
                    for first, places, scores in cell.search(_units(part.column(6), width), part.column(7).to_pylist(), k):
                        there = scores > -np.inf
                        found = [(ids[first + i], cell.ids[places[i][there[i]]], scores[i][there[i]]) for i in np.flatnonzero(there[:, 0])]
                        yield _rows(found, batch.column(2).type)

    placed = both.repartition("cell").sortWithinPartitions("cell", "kind")
    return placed.mapInArrow(run, _hits(cells.schema["id"].dataType))


def _asked(queries: DataFrame) -> DataFrame:
    """Stored queries with a direction."""
    if "l1_domain" not in queries.columns:
        queries = queries.withColumn("l1_domain", F.lit(None).cast("string"))
    rows = queries.select(F.col("query_id").cast("bigint"), "embedding", "l1_domain").filter(usable(F.col("embedding")))
    return cut(rows, "query-vectors")


def _searched(corpus: DataFrame, id_col: str, vector: str, domain: str | None, width: int, *more: str) -> DataFrame:
    return corpus.filter(usable(F.col(vector), width)).select(
        F.col(id_col).alias("id"), F.col(vector).alias("vector"),
        (F.col(domain) if domain else F.lit(None)).cast("string").alias("domain"), *more,
    )


def _widths(rows: DataFrame) -> list[int]:
    return sorted(r[0] for r in rows.select(F.size("embedding")).distinct().collect())


def rejected_queries(queries: DataFrame, width: int) -> DataFrame:
    """Queries that no search answers, with the reason."""
    vector = F.col("embedding")
    reason = (
        F.when(vector.isNull(), "no vector")
        .when(F.size(vector) != width, "other width")
        .when(F.exists(vector, lambda x: x.isNull() | F.isnan(x)), "missing entries")
        .when(~F.exists(vector, lambda x: x != 0), "zero vector")
    )
    return queries.withColumn("reason", reason).filter("reason IS NOT NULL")


def _ranked(hits: DataFrame, k: int, id_col: str) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
    top = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return top.withColumnRenamed("id", id_col)


def _with_columns(top: DataFrame, corpus: DataFrame, id_col: str, keep: list[str] | None) -> DataFrame:
    if not keep:
        return top
    # Written, so that the planner sees its size and leaves the corpus unshuffled.
    return cut(top, "top-k").join(corpus.select(id_col, *keep), id_col)


def vector_topk(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = TOP_K,
    id_col: str = "thread_id",
    vector: str = "embedding",
    domain: str | None = "l1_domain",
    keep: list[str] | None = None,
) -> DataFrame:
    """k nearest corpus rows per query by cosine, with ``rank`` and ``score``.

    ``queries`` has query_id, embedding and optionally l1_domain, which restricts
    that query to rows of the same domain. Written queries of up to ``QUERY_BYTES``
    are sent to every task of one map-only pass over the corpus. More of them meet
    the corpus, which is then shuffled once into cells, cell by cell. Only k rows per
    query and task or cell are shuffled on. Scores count to 12 digits, equal ones go by id.
    """
    rows = _asked(queries)
    hits = corpus.sparkSession.createDataFrame([], _hits(corpus.schema[id_col].dataType))
    for width in _widths(rows):
        some = rows.filter(F.size("embedding") == width)
        searched = _searched(corpus, id_col, vector, domain, width)
        if size_in_bytes(rows) <= QUERY_BYTES:
            part = _search_in_place(searched, some, width, k)
        else:
            cells = searched.count() * width * 8 // CELL_BYTES + 1
            dealt = searched.withColumn("cell", F.pmod(F.xxhash64("id"), F.lit(cells)))
            everywhere = some.withColumn("cell", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(cells - 1).cast("bigint"))))
            part = _search_cells(dealt, everywhere, width, k)
        hits = hits.unionByName(part)
    return _with_columns(_ranked(hits, k, id_col), corpus, id_col, keep)


def pick_leaders(
    corpus: DataFrame, n: int, id_col: str = "thread_id", vector: str = "embedding", seed: str = "0"
) -> DataFrame:
    """``n`` vectors drawn by seeded hash, as leaders (leader_id, embedding); stored."""
    draw = F.md5(F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string")))
    drawn = corpus.filter(usable(F.col(vector))).select(draw.alias("_d"), id_col, vector).orderBy("_d", id_col).limit(n)
    drawn = cut(drawn.withColumn("_row", F.monotonically_increasing_id()), "drawn")
    number = F.row_number().over(W.orderBy("_d", id_col, "_row")) - 1  # n hashes and ids, without vectors
    numbers = drawn.select("_row", number.cast("int").alias("leader_id"))
    return cut(drawn.join(numbers, "_row").select("leader_id", F.col(vector).alias("embedding")), "leaders")


def follow_leaders(corpus: DataFrame, leaders: DataFrame, vector: str = "embedding") -> DataFrame:
    """Add ``leader_id`` of the nearest leader (lowest id on ties).

    All rows stay: one without a direction (NULL, zero, of another width) has no
    leader. Each row is a query among the leaders. Leaders of up to ``QUERY_BYTES``
    make it a map-only pass; more of them lie in cells that the rows pass.

    Stored partitioned by ``leader_id`` (``write_layer``), a search reads only the
    clusters it probes.
    """
    width = leaders.select(F.max(F.size("embedding"))).first()[0]
    if width is None:
        return corpus.withColumn("leader_id", F.lit(None).cast("int"))
    if size_in_bytes(leaders) > QUERY_BYTES:
        rows = cut(corpus.withColumn("_row", F.monotonically_increasing_id()), "followers")
        asked = rows.filter(usable(F.col(vector), width)).select(F.col("_row").alias("query_id"), F.col(vector).alias("embedding"))
        near = vector_topk(leaders, asked, 1, "leader_id", domain=None)
        return rows.join(near.select(F.col("query_id").alias("_row"), "leader_id"), "_row", "left").drop("_row")
    held = leaders.orderBy("leader_id").toArrow()  # bounded by QUERY_BYTES on disk
    shared = corpus.sparkSession.sparkContext.broadcast(
        (held.column("leader_id").to_pylist(), _units(held.column("embedding").combine_chunks(), width))
    )
    out = T.StructType(corpus.schema.fields + [T.StructField("leader_id", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, units = shared.value
        leader_ids = np.array(ids, np.int32)
        for batch in batches:
            fit = np.flatnonzero(batch.column("_fits").to_numpy(zero_copy_only=False))
            leader, none = np.zeros(len(batch), np.int32), np.ones(len(batch), bool)
            for at in range(0, len(fit), SCORE_ROWS):
                some = fit[at : at + SCORE_ROWS]
                places, scores = _best(_units(batch.column(vector).take(pa.array(some)), width) @ units.T, 1)
                leader[some], none[some] = leader_ids[places[:, 0]], scores[:, 0] == -np.inf
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(leader, pa.int32(), mask=none)], names=[*batch.schema.names[:-1], "leader_id"],
            )

    return corpus.withColumn("_fits", usable(F.col(vector), width)).mapInArrow(run, out)


def probes(
    queries: DataFrame, leaders: DataFrame, sizes: DataFrame, need: int, domain: bool = False
) -> DataFrame:
    """(query_id, leader_id): each query's nearest clusters until they hold ``need`` rows.

    ``sizes`` is (leader_id, n), with ``domain`` (leader_id, domain, n). A query looks at
    its nearest ``PROBES`` clusters first; those that hold too few rows of its
    domain look at four times as many, and so on up to all clusters.
    """
    total = leaders.count()
    whole = sizes.groupBy("leader_id").agg(F.sum("n").alias("whole"))
    left, seen, chosen = queries, PROBES, None
    while True:
        near = vector_topk(leaders, left.select("query_id", "embedding"), seen, "leader_id", domain=None)
        near = near.join(left.select("query_id", "l1_domain"), "query_id").join(whole, "leader_id", "left")
        held = F.coalesce("whole", F.lit(0))
        if domain:
            own = sizes.select("leader_id", F.col("domain").alias("l1_domain"), F.col("n").alias("own"))
            near = near.join(own, ["leader_id", "l1_domain"], "left")
            held = F.when(F.col("l1_domain").isNull(), held).otherwise(F.coalesce("own", F.lit(0)))
        upto = W.partitionBy("query_id").orderBy("rank")
        near = near.select(
            "query_id", "leader_id",
            F.coalesce(F.sum(held).over(upto.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"),
            F.sum(held).over(W.partitionBy("query_id")).alias("all"),
        )
        near = cut(near, "near-clusters")
        enough = (F.col("all") >= need) | F.lit(seen >= total)
        part = near.filter(enough & (F.col("before") < need)).select("query_id", "leader_id")
        chosen = part if chosen is None else chosen.unionByName(part)
        if seen >= total:
            return chosen
        short = near.filter(~enough).select("query_id").distinct()
        left, seen = cut(left.join(short, "query_id", "left_semi"), "short-queries"), min(4 * seen, total)
        if left.isEmpty():
            return chosen


def vector_topk_pruned(
    clustered: DataFrame,
    leaders: DataFrame,
    queries: DataFrame,
    k: int = TOP_K,
    candidates: int | None = None,
    id_col: str = "thread_id",
    vector: str = "embedding",
    domain: str | None = "l1_domain",
    keep: list[str] | None = None,
) -> DataFrame:
    """Approximate top-k: rank only the clusters nearest to each query.

    Each query probes its nearest clusters until they hold ``candidates`` rows
    (default 10·k) of its domain, then ranks all of them exactly. Clusters are
    inverted lists, large ones of several cells; queries join the cells of the
    clusters they probe, and clusters that nobody probes are not read if the corpus is
    stored by ``leader_id``.
    """
    need = candidates or CANDIDATES_PER_K * k
    rows = _asked(queries)
    hits = clustered.sparkSession.createDataFrame([], _hits(clustered.schema[id_col].dataType))
    for width in _widths(rows):
        some = rows.filter(F.size("embedding") == width)
        searched = _searched(clustered.filter(F.col("leader_id").isNotNull()), id_col, vector, domain, width, "leader_id")
        sizes = cut(searched.groupBy("leader_id", "domain").agg(F.count("*").alias("n")), "cluster-sizes")
        picked = cut(probes(some, leaders, sizes, need, domain is not None), "probes")
        per_cell = max(1, CELL_BYTES // (8 * width))
        lists = cut(
            picked.select("leader_id").distinct().join(sizes.groupBy("leader_id").agg(F.sum("n").alias("n")), "leader_id")
            .select("leader_id", F.ceil(F.col("n") / per_cell).alias("cells")),
            "probed-clusters",
        )
        first = F.col("leader_id").cast("bigint") * F.lit(1 << 32)
        dealt = searched.join(lists, "leader_id").withColumn("cell", first + F.pmod(F.xxhash64("id"), F.col("cells")))
        asked = picked.join(lists, "leader_id").join(some, "query_id").withColumn(
            "cell", F.explode(F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("cells") - 1), lambda i: first + i))
        )
        hits = hits.unionByName(_search_cells(dealt, asked, width, k))
    return _with_columns(_ranked(hits, k, id_col), clustered, id_col, keep)


def recall(found: DataFrame, exact: DataFrame, id_col: str = "thread_id") -> DataFrame:
    """(query_id, wanted, found): how many of a query's exact results a search found."""
    both = exact.select("query_id", id_col).join(
        found.select("query_id", id_col, F.lit(1).alias("_hit")), ["query_id", id_col], "left"
    )
    return both.groupBy("query_id").agg(F.count("*").alias("wanted"), F.count("_hit").alias("found"))


def hashed_embedding(df: DataFrame, text: str, dimensions: int = DIMENSIONS) -> DataFrame:
    """Add ``embedding``: unit vectors of signed feature hashes of the words.

    Words are what blanks separate, A-Z lower-cased. The first eight hex digits of a word's
    MD5 choose its entry, the ninth its sign. A text without words has a zero vector.
    """
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[bytes, tuple[int, int]] = {}  # of one batch
            for start in range(0, len(batch), 512):
                part = batch.slice(start, 512)
                vectors = np.zeros((len(part), dimensions))
                for row, value in enumerate(part.column("_text").to_pylist()):
                    for word in (value or b"").translate(lower).split():
                        if word not in known:
                            digest = hashlib.md5(word).hexdigest()
                            known[word] = int(digest[:8], 16) % dimensions, 1 if int(digest[8], 16) < 8 else -1
                        at, sign = known[word]
                        vectors[row, at] += sign
                norms = np.linalg.norm(vectors, axis=1, keepdims=True)
                unit = (vectors / np.where(norms > 0, norms, 1)).astype(np.float32)
                starts = pa.array(np.arange(0, unit.size + 1, dimensions), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.ListArray.from_arrays(starts, pa.array(unit.ravel()))],
                    names=[*part.schema.names[:-1], "embedding"],
                )

    out = T.StructType(df.schema.fields + [T.StructField("embedding", T.ArrayType(T.FloatType()))])
    return df.withColumn("_text", F.col(text).cast("binary")).mapInArrow(run, out)


def embed(
    documents: DataFrame, fn: Callable[[dict], list[float]] | None = None, dimensions: int = DIMENSIONS
) -> tuple[DataFrame, DataFrame]:
    """(thread_id, summary, l1_domain) → vector documents and failed documents.

    ``fn`` is the embedding model; without it, feature hashing is used.
    """
    carried = ["thread_id", "summary", "l1_domain"]
    rows = documents.select(*carried)
    if fn is None:
        none = rows.sparkSession.createDataFrame([], "thread_id string, error string")
        return hashed_embedding(rows, "summary", dimensions), none
    results = map_model(rows, fn, carried, "array<float>")
    good = succeeded(results).withColumnRenamed("result", "embedding")
    return good, failed(results).select("thread_id", "error")


def embed_and_store(
    documents: DataFrame, base: str, name: str, fn: Callable[[dict], list[float]] | None = None, dimensions: int = DIMENSIONS
) -> tuple[int, DataFrame]:
    """Embed documents and upsert the vectors by thread; rows of the layer, and failed documents."""
    vectors, lost = embed(documents, fn, dimensions)
    return upsert_layer(vectors, base, name, ["thread_id"]), lost
