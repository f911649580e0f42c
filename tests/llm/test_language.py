import zlib

import numpy as np
import pytest

from threadloom.llm import language as lg
from threadloom.llm.common import table

FOLDER = "/root/testdata/sf0.01"


def grams(part, p):
    found = set()
    for n in range(1, p.longest + 1):
        for i in range(len(part) - n + 1):
            g = part[i:i + n]
            if not (g[0] == 32 and g[-1] == 32):
                code = 0
                for b in g:
                    code = (code * 257 + b) % 2**32
                found.add((code * 2654435761 + n * 40503) % 2**32 >> (32 - p.buckets.bit_length() + 1))
    return found


def test_presence_and_kernel():
    p = lg.LanguageParams()
    parts = [b"the cat  sat", b"", b"a", "été ".encode() * 9]
    rows = lg.presence(parts, p)
    assert [set(np.flatnonzero(r)) for r in rows] == [grams(x, p) for x in parts]
    k = lg.normalised(rows) @ lg.normalised(rows).T
    assert k[0, 0] == pytest.approx(1) and k[1, 1] == 0


def test_folded_scores_equal_kernel_scores():
    p = lg.LanguageParams(landmarks=1000)
    rng = np.random.default_rng(0)
    data = [(lab, "".join(rng.choice(list(chars), 80)).encode()) for lab, chars in (("a", "abcde "), ("b", "cdefg "), ("c", "xyz ")) for _ in range(20)]
    model = lg.fit(data, p)
    x = lg.normalised(lg.presence([d for _, d in data], p)).astype(float)
    k = x @ x.T
    k0 = k - k.mean(axis=0) - k.mean(axis=1)[:, None] + k.mean()
    y = np.where(np.array([lab for lab, _ in data])[:, None] == np.array(["a", "b", "c"]), 1.0, -1.0)
    exact = k0 @ np.linalg.solve(k0 + p.ridge * np.eye(len(k)), y - y.mean(axis=0)) + y.mean(axis=0)
    assert np.abs(model.values([d for _, d in data]) - exact).max() < 1e-2


def test_held_out_accuracy_and_rows(spark):
    docs = table(spark, FOLDER, "documents")
    truth = {r.doc_id: r for r in docs.collect()}
    out = lg.identify(docs).collect()
    assert len(out) == len(truth)
    right = [r.lang_pred == truth[r.doc_id].lang for r in out if r.held_out and len(truth[r.doc_id].text) > 200]
    assert np.mean(right) > 0.98
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1


def test_edge_cases(spark):
    schema = "doc_id long, text string, lang string, score double, label string"
    texts = ["the cat sat on the mat and that was that", "el gato se sienta sobre la alfombra y ya"]
    rows = [(i, texts[i % 2], ["en", "es"][i % 2], 1.0, "x") for i in range(40)]
    rows += [(100, None, "en", 0.0, "x"), (101, "", None, 0.0, "x"), (102, "123 $$ ²", "es", 0.0, "x"), (None, texts[0], "es", 0.0, "x"),
             (103, "the cat and that was " * 20000, None, 0.0, "x")]
    out = {r.doc_id: r for r in lg.identify(spark.createDataFrame(rows, schema)).collect()}
    assert [(out[i].lang_pred, out[i].score) for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert out[103].lang_pred == "en" and out[None].lang_pred == "en" and out[None].held_out is False
    assert lg.identify(spark.createDataFrame([], schema)).count() == 0
    none = lg.identify(spark.createDataFrame([(1, "abc", None, 0.0, "x")], schema)).first()
    assert (none.lang_pred, none.score) == ("und", 0.0)
