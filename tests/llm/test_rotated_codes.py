import numpy as np
from pyspark.sql import functions as F

from threadloom.llm import rotated_codes as rc
from threadloom.llm.common import table

FOLDER = "/root/testdata/sf0.01"


def brute(ids, x, q, k=10):
    own = ids == ids[q]
    d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
    order = [i for i in np.lexsort((ids, d)) if not own[i]][:k]
    return [(int(ids[i]), d[i]) for i in order]


def test_bounds_hold():
    rng = np.random.default_rng(0)
    x, q = rng.standard_normal((3000, 70)), rng.standard_normal((40, 70))
    centre, turn = x.mean(axis=0), rc.rotation(70, 1)
    assert np.allclose(turn @ turn.T, np.eye(70))
    low, high = rc.Asked(q, centre, turn, 4.0).bounds(*rc.encode(x, centre, turn))
    true = ((q[:, None] - x[None]) ** 2).sum(axis=-1)
    assert ((low <= true) & (true <= high)).mean() > 0.999
    assert np.abs((low + high) / 2 - true).mean() < 0.25 * true.mean()


def test_recall_and_scores(spark):
    vectors = table(spark, FOLDER, "embeddings")
    rows = vectors.orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    out = {}
    for r in rc.nearest(vectors, F.col("vec_id") % 100 == 0).collect():
        out.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert sorted(out) == [int(i) for i in ids if i % 100 == 0]
    hits = 0
    for q, found in out.items():
        want = brute(ids, x, int(np.flatnonzero(ids == q)[0]))
        got = [found[k] for k in range(1, 11)]
        assert got == sorted(got, key=lambda v: (v[1], v[0]))
        hits += len({i for i, _ in want} & {i for i, _ in got})
        for i, score in got:
            assert abs(score - np.sqrt(((x[ids == i][0] - x[ids == q][0]) ** 2).sum())) < 1e-12
    assert hits >= 0.97 * 10 * len(out)


def test_edge_cases(spark):
    schema = "vec_id long, embedding array<double>, query_id long, rank int"
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0]), (4, None), (5, [None, 1.0]), (6, [inf, 1.0]),
            (7, [nan, 1.0]), (100, [5.0, 5.0]), (None, [1.0, 0.0]), (8, [1.0, 0.0, 0.0]), (2, [1.0, 1.0]), (200, [0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1, 1) for i, v in rows], schema)
    out = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in rc.nearest(df, F.col("vec_id") % 100 == 0).collect())
    assert [(q, n, i) for q, n, i, _ in out] == [(0, 1, 1), (0, 2, 2), (0, 3, 2), (0, 4, 100), (100, 1, 1), (100, 2, 2), (100, 3, 2), (100, 4, 0)]
    assert out[0][3] == 1.0
    assert rc.nearest(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_passes(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, 16))
    x[50:60] = x[0]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(5)
    monkeypatch.setattr(rc, "PASS_BYTES", 8 * 16 * 8)
    p = rc.CodeParams(epsilon=6.0)
    got = {}
    for r in rc.nearest(df, F.col("vec_id") % 10 == 0, p).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    ids = np.arange(400)
    assert got == {q: [i for i, _ in brute(ids, x, q)] for q in range(0, 400, 10)}
