"""Cosine scores, exact and pruned top-k."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.lineage import cut
from threadloom.operators import vectors as V
from threadloom.sources.layers import read_layer, upsert_layer

DOCS = "thread_id string, summary string, l1_domain string, embedding array<float>"
ASKED = "query_id bigint, embedding array<float>, l1_domain string"


def test_cosine_cases(spark):
    rows = [([1.0, 0.0], [2.0, 0.0]), ([1.0, 0.0], [0.0, 3.0]), ([1.0, 0.0], [-1.0, 0.0]), ([0.0, 0.0], [1.0, 0.0])]
    df = spark.createDataFrame(rows, "a array<float>, b array<float>")
    assert [r[0] for r in df.select(V.cosine(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, -1.0, None]


def corpus(spark, n=600, dims=8, seed=3):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, dims)).astype("float32")
    m[: n // 3] = m[0]  # a third are copies of one vector
    rows = [
        (f"t{i:04d}", f"s{i}", f"d{i % 4}", [float(x) for x in m[i]]) for i in range(n)
    ] + [("zero", "z", "d0", [0.0] * dims), ("short", "z", "d0", [1.0]), ("none", "z", "d0", None)]
    return m, spark.createDataFrame(rows, DOCS)


def brute(m, q, k, domain=None):
    q = np.asarray(q)
    sims = (m.astype(float) @ q) / (np.linalg.norm(m.astype(float), axis=1) * np.linalg.norm(q))
    ids = [i for i in range(len(m)) if domain is None or f"d{i % 4}" == domain]
    return [f"t{i:04d}" for i in sorted(ids, key=lambda i: (-round(sims[i], 12), i))[:k]]


def test_exact_topk(spark):
    m, df = corpus(spark)
    asked = [(0, [float(x) for x in m[0]], None), (1, [1.0] * 8, "d2"), (2, [float(x) for x in m[500]], None),
             (3, [0.0] * 8, None), (4, [1.0] * 8, "absent")]
    top = V.vector_topk(df, spark.createDataFrame(asked, ASKED), 5, keep=["summary", "l1_domain"])
    got = {}
    for r in top.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["thread_id"])
        assert r["summary"] == f"s{int(r['thread_id'][1:])}"
    assert got == {q: brute(m, v, 5, d) for q, v, d in asked[:3]}


@pytest.mark.parametrize("small", [16 << 20, 0])
def test_many_queries(spark, monkeypatch, small):
    """By broadcast and by cells; either scores some rows and queries at a time."""
    m, df = corpus(spark, n=300)
    for name, value in (("QUERY_BYTES", small), ("SCORE_ROWS", 50), ("SCORE_QUERIES", 7), ("CELL_BYTES", 5000)):
        monkeypatch.setattr(V, name, value)
    asked = [(i, [float(x) for x in m[i + 90]], f"d{i % 4}" if i % 3 == 0 else None) for i in range(200)]
    top = V.vector_topk(df, spark.createDataFrame(asked, ASKED).repartition(3), 4)
    got = {}
    for r in top.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["thread_id"])
    assert got == {i: brute(m, v, 4, d) for i, v, d in asked}


def test_hundred_thousand_queries_pass_one_scan(spark, monkeypatch):
    m, df = corpus(spark, n=600)
    monkeypatch.setattr(V, "QUERY_BYTES", 1 << 20)
    queries = spark.range(100_000).select(
        F.col("id").alias("query_id"), F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: F.sin(i * F.col("id") + i).cast("float")).alias("embedding"))
    top = V.vector_topk(df, queries, 2, domain=None)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 1  # the stored queries; the corpus of the test is in memory
    out = cut(top, "top")
    assert out.count() == 200_000
    some = [r["query_id"] for r in out.select("query_id").distinct().orderBy(F.xxhash64("query_id")).limit(20).collect()]
    asked = {r["query_id"]: r["embedding"] for r in queries.filter(F.col("query_id").isin(some)).collect()}
    found = {}
    for r in out.filter(F.col("query_id").isin(some)).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r["thread_id"])
    assert found == {q: brute(m, v, 2) for q, v in asked.items()}


def test_best_takes_the_first_of_equal_scores():
    sims = np.array([[1.0, 3.0, 3.0, 3.0, 2.0], [5.0, 5.0, 5.0, 5.0, 5.0], [np.nan, 1.0, -np.inf, 0.5, np.nan]])
    places, scores = V._best(sims, 2)
    assert places.tolist() == [[1, 2], [0, 1], [1, 3]] and scores[2].tolist() == [1.0, 0.5]


def test_no_queries(spark):
    _, df = corpus(spark, n=20)
    assert V.vector_topk(df, spark.createDataFrame([], ASKED), 3).isEmpty()


@pytest.mark.parametrize("small", [16 << 20, 0])
def test_pruned_topk(spark, monkeypatch, small):
    """Probing every cluster is exact; probing few still finds a stored vector itself."""
    m, df = corpus(spark)
    if small == 0:
        monkeypatch.setattr(V, "CELL_BYTES", 8 * 8 * 50)
    monkeypatch.setattr(V, "QUERY_BYTES", small)
    leaders = V.pick_leaders(df.filter(F.size("embedding") == 8), 16)
    clustered = cut(V.follow_leaders(df, leaders), "test-clusters")
    assert clustered.count() == df.count() > len(m)
    assert clustered.filter("leader_id IS NULL").count() == df.count() - len(m)
    asked = [(i, [float(x) for x in m[i]], None) for i in range(300, 320)]
    queries = spark.createDataFrame(asked, ASKED)
    every = V.vector_topk_pruned(clustered, leaders, queries, 5, candidates=10**6)
    got = {}
    for r in every.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["thread_id"])
    assert got == {q: brute(m, v, 5) for q, v, _ in asked}
    few = V.vector_topk_pruned(clustered, leaders, queries, 1).collect()
    assert {r["query_id"]: r["thread_id"] for r in few} == {i: f"t{i:04d}" for i in range(300, 320)}
    ten = V.recall(V.vector_topk_pruned(clustered, leaders, queries, 10, candidates=300), V.vector_topk(df, queries, 10))
    assert ten.agg(F.sum("found") / F.sum("wanted")).first()[0] > 0.7


def test_probes_stop_when_enough_rows_are_held(spark, monkeypatch):
    """Few rows of the query's domain near by: more clusters are probed."""
    monkeypatch.setattr(V, "PROBES", 1)
    leaders = spark.createDataFrame([(i, [float(np.cos(i / 5)), float(np.sin(i / 5))]) for i in range(7)], "leader_id int, embedding array<float>")
    sizes = spark.createDataFrame([(i, d, n) for i in range(7) for d, n in (("a", 5), ("b", int(i == 5)))], "leader_id int, domain string, n bigint")
    queries = spark.createDataFrame([(1, [1.0, 0.0], None), (2, [1.0, 0.0], "a"), (3, [1.0, 0.0], "b"), (4, [1.0, 0.0], "c")], ASKED)
    got = {}
    for r in V.probes(queries.select("query_id", "embedding", "l1_domain"), leaders, sizes, 7, domain=True).collect():
        got.setdefault(r["query_id"], set()).add(r["leader_id"])
    assert got == {1: {0, 1}, 2: {0, 1}, 3: set(range(7)), 4: set(range(7))}


def test_embed_and_store(spark, tmp_path):
    docs = spark.createDataFrame(
        [("a", "one two", "ROOT A"), ("b", "bad", "ROOT B")], "thread_id string, summary string, l1_domain string"
    )

    def model(row):
        if row["summary"] == "bad":
            raise ValueError("no")
        return [1.0, 2.0]

    vectors, lost = V.embed(docs, model)
    assert [tuple(r) for r in lost.collect()] == [("b", "ValueError: no")]
    base = str(tmp_path)
    assert upsert_layer(vectors, base, "v", ["thread_id"]) == 1
    hashed, none = V.embed(docs, dimensions=64)
    assert none.isEmpty()
    for r in hashed.collect():
        assert len(r["embedding"]) == 64 and abs(np.linalg.norm(r["embedding"]) - 1) < 1e-6
    assert upsert_layer(hashed, base, "v", ["thread_id"]) == 2
    stored = {r["thread_id"]: r["embedding"] for r in read_layer(spark, base, "v").collect()}
    assert len(stored["a"]) == 64 and set(stored) == {"a", "b"}
