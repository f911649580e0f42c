import random
import re

import numpy as np
import pytest

from threadloom.llm import minhash as mh
from threadloom.llm.common import table
from threadloom.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, words):
    w = WORD.findall((text or "").translate(LOWER))
    n = min(words, len(w))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()


def brute(texts, words):
    """{row: (size, root)} by comparing every pair that shares a shingle."""
    sets = [shingle_set(t, words) for t in texts]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {(a, b) for v in holders.values() for a in v for b in v if a < b}
    for a, b in pairs:
        common = len(sets[a] & sets[b])
        if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
            parent[root(b)] = root(a)
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def agrees(rows, ids, texts, words):
    want = brute(texts, words)
    least = {}
    for i, (_, r) in zip(ids, want):
        least[r] = min(least.get(r, i), i)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
    for i, (n, r) in zip(ids, want):
        assert got[i] == (n, least[r], i == least[r]), i
    assert len(rows) == len(ids)


def family(rng, vocabulary, copies, length, edits):
    base = [rng.choice(vocabulary) for _ in range(length)]
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(length)] = rng.choice(vocabulary)
        yield " ".join(w)


def corpus(seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for copies, length, edits in ((60, 120, 8), (3, 40, 2), (2, 30, 1), (40, 60, 5), (80, 200, 22)):
        texts += family(rng, vocabulary, copies, length, edits)
    shared = " ".join(rng.choice(vocabulary) for _ in range(60))
    texts += [shared + " " + " ".join(rng.choice(vocabulary) for _ in range(40)) for _ in range(40)]
    texts += [texts[0]] * 10 + [texts[70].upper()] + [f"{t}\n" for t in texts[:3]]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("blocks", [(2048, 384), (16, 10)])
def test_families_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(mh, "BUCKET_BLOCK", blocks[0])
    monkeypatch.setattr(mh, "FAMILY_BLOCK", blocks[1])
    texts = corpus()
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, size long, label string")
    agrees(mh.near_duplicates(df, mh.NearParams(words=4)).collect(), range(len(texts)), texts, 4)


def test_small_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    out = mh.near_duplicates(docs, mh.NearParams(words=4)).collect()
    agrees(out, [i for i, _ in rows], [t for _, t in rows], 4)


def test_signature_estimate():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, 2000, dtype=np.uint64)
    for share in (1.0, 0.8, 0.5, 0.0):
        a, b = np.unique(base[:1000]), np.unique(base[int(1000 * (1 - share)):int(1000 * (1 - share)) + 1000])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        codes = [np.frombuffer(mh.signature(mh.minima(x)), "<u8")[None] for x in (a, b)]
        assert abs(mh.similarity(mh.equal_fields(*codes))[0, 0] - true) < 0.12
    assert 0.5 < mh.similarity(np.array(mh.NearParams().least_fields())) < 0.7


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, "É a b c"), (7, "é a b c"), (None, "one two"),
            (8, "x " * 30000), (9, "x " * 30001), (4, "one two")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted(mh.near_duplicates(df).collect(), key=str)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out}
    assert len(out) == len(rows)
    assert [got[i] for i in (1, 2, 3)] == [(0, i, True) for i in (1, 2, 3)]
    assert got[4] == (1, 4, True) and got[5] == (1, 4, False) and got[None] == (1, 4, False)
    assert got[6] == (1, 6, True) and got[7] == (1, 7, True) and got[9] == (1, 8, False)
    assert mh.near_duplicates(df.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(200)] + [(500, j) for j in range(501, 600)] + [(rng.randrange(1000, 2000), rng.randrange(1000, 2000)) for _ in range(700)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    rng.shuffle(edges)
    df = spark.createDataFrame([(a, b) if rng.random() < 0.5 else (b, a) for a, b in edges], "a long, b long")
    got = {r.id: r.label for r in components(df).collect()}
    assert got == {x: root(x) for e in edges if e[0] != e[1] for x in e}
    assert components(df.limit(0)).count() == 0
