import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from threadloom.llm.lexical_search import Lists, SearchParams, search

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, item string, score long, terms string"
ITEMS = "item_id long, text string, doc_id long, rank int"


def terms(text):
    return TERMS.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_all = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = Counter()
    for item, text in items:
        scores = []
        for i, counts in held:
            m = 25 + (75 * sum(counts.values()) * n_docs) // n_all
            score = 0
            for t, times in Counter(terms(text)).items():
                if t in counts:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * (10**9 * counts[t] // (1000 * counts[t] + 8 * m))
            if score:
                scores.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1):
            out[item, rank, i, -score] += 1
    return out


def compare(spark, docs, items, parts=3, **params):
    d = spark.createDataFrame([(i, t, "clash", 1, "clash") for i, t in docs], DOCS).repartition(parts)
    a = spark.createDataFrame([(i, t, 5, 5) for i, t in items], ITEMS)
    p = SearchParams(**params)
    got = Counter(tuple(r) for r in search(d, a, params=p).collect())
    assert got == brute(docs, items, p.k)
    return got


def corpus(rng, n, words):
    return [(i, " ".join(rng.choice(words[: 2 + rng.randrange(len(words))]) for _ in range(rng.randrange(80)))) for i in range(n)]


@pytest.mark.parametrize("params", [{}, {"k": 3, "first_read": 1, "pass_bytes": 40}, {"first_read": 2, "block_postings": 30}])
def test_against_brute_force(spark, params):
    rng = random.Random(4)
    words = ["the", "The", "of", "a1", "é", "É", "日本", "x9", *(f"w{i}" for i in range(30))]
    docs = corpus(rng, 300, words) + [(900, None), (901, ""), (902, "!!"), (None, "the of w3 w3"), (7, "w3 w4 rare")]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 12)))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "nowhere to be found"), (3, "w3 w3 w3 w4"), (None, "rare of")]
    compare(spark, docs, items, **params)


def test_ties_by_id_with_null_last(spark):
    docs = [(i, "same words here") for i in range(40, 0, -1)] + [(None, "same words here")] * 3 + [(99, "other text")]
    got = compare(spark, docs, [(1, "words same")], parts=7)
    assert sorted(r[2] for r in got) == list(range(1, 11))
    few = [(None, "same words here"), (5, "same words here"), (6, "no")]
    assert [r[2] for r in sorted(compare(spark, few, [(1, "same")]), key=lambda r: r[1])] == [5, None]


def test_copies_and_long_text(spark):
    rng = random.Random(8)
    docs = corpus(rng, 50, ["u", "v", "w", "x"]) + [(1000 + i, "u v w w") for i in range(3000)] + [(5, "u " * 400_000 + "v")]
    compare(spark, docs, [(1, "u"), (2, "v w"), (3, "x x u")])


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "a b", "", 1, "")], DOCS)
    asked = spark.createDataFrame([(1, "a", 1, 1)], ITEMS)
    assert [search(d, a).count() for d, a in ((docs, items), (some, items), (docs, asked))] == [0, 0, 0]
    none = spark.createDataFrame([(1, None, "", 1, ""), (2, "..", "", 1, "")], DOCS)
    assert search(none, asked).count() == 0


def test_reading_stops_before_the_lists_end():
    """One document leads by far: the rest of a long list is not read."""
    n = 5000
    docs = np.concatenate([np.arange(n), np.arange(10)])
    impacts = np.concatenate([np.r_[np.full(10, 1000), np.ones(n - 10, int)], np.full(10, 500)]).astype(np.int64)
    of = np.concatenate([np.zeros(n, int), np.ones(10, int)])
    lists = Lists(of, docs, impacts, 2)
    read = []
    lists.docs = type("Counted", (), {"__getitem__": lambda s, part, d=lists.docs: (read.append(part), d[part])[1]})()
    found, scores = lists.best(np.array([0, 1]), np.array([1, 1]), n, 10, 0, 16)
    assert sorted(found) == list(range(10)) and set(scores) == {1500}
    assert max(p.stop for p in read if p.start < n) <= 64
