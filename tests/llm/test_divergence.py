import random
import re
from collections import Counter, defaultdict

import numpy as np

from threadloom.llm.divergence import DivergenceParams, skyband, source_divergence

TERMS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, term string, n long"


def brute(rows, least=10, k=10):
    rows = [(t or "", lang or "", s or "") for t, lang, s in rows]
    n, docs, langs = Counter(), Counter(), defaultdict(set)
    for text, lang, source in rows:
        langs[lang].add(source)
        terms = TERMS.findall(text.translate(LOWER))
        n.update((lang, source, t) for t in terms)
        docs.update((lang, t) for t in set(terms))
    out = set()
    for lang, sources in langs.items():
        kept = sorted({t for x, t in docs if x == lang and docs[x, t] >= least})

        def shares(counts):
            total = sum(counts.values())
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: shares({t: n[lang, s, t] for t in kept}) for s in sources}
        q = shares({t: sum(n[lang, s, t] for s in sources) for t in kept})
        for s in sources:
            def f(a, b):
                return (a - b) ** 2 // (a + b)

            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources - {s}]
            terms = [(f(p[s][t], q[t]), t) for t in kept if n[lang, s, t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, k)):
                for rank, (v, item) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out.add((lang, s, part, item, v, rank))
    return out


def compare(spark, rows, **params):
    docs = spark.createDataFrame([(i, *r, "clash", 7) for i, r in enumerate(rows)], SCHEMA)
    p = DivergenceParams(**params)
    got = [tuple(r) for r in source_divergence(docs, p).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, p.least_docs, p.k)
    return got


def corpus(rng, docs, langs, sources, vocabulary):
    rows = []
    for _ in range(docs):
        lang, source = rng.choice(langs), rng.choice(sources)
        words = [rng.choice(vocabulary[: 5 + rng.randrange(len(vocabulary))]) for _ in range(rng.randrange(60))]
        rows.append((" ".join(words), lang, source))
    return rows


def test_against_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [a + b for a in "aAéßzZ日" for b in "bcdefgh9x"] + ["The", "the", "THE"]
    rows = corpus(rng, 300, ["en", "de", None, ""], ["a", "b", "é", None], vocabulary)
    compare(spark, rows + rows[:20])
    compare(spark, rows, least_docs=3, k=4, held=50, cells=40)


def test_ties_rank_by_bytes(spark):
    rows = [("z y x w v u t s r q p o 日 é", "en", s) for s in "ab" for _ in range(10)] + [("other", "en", "c")] * 30
    got = compare(spark, rows, k=10)
    assert [r[3] for r in sorted(got, key=lambda r: r[5]) if r[1:3] == ("a", "term")] == list("opqrstuvwx")


def test_groups_without_terms(spark):
    got = compare(spark, [(None, "en", "a"), ("", "en", "b"), ("12 34", "en", None), ("few words", "fr", "x")])
    assert {r[2] for r in got} == {"pair"} and {r[4] for r in got} == {0}
    assert source_divergence(spark.createDataFrame([], SCHEMA)).count() == 0


def test_hot_source_and_long_text(spark):
    rng = random.Random(9)
    rows = corpus(rng, 60, ["en"], ["a", "b"], ["alpha", "beta", "gamma"]) + [("alpha beta " * 200_000, "en", "hot")]
    compare(spark, rows + [("gamma", "en", "hot")] * 200)


def test_skyband_retains_what_fewer_than_k_dominate():
    rng = np.random.default_rng(2)
    for size in (0, 1, 30, 700):
        n, lang_n = rng.integers(1, 12, size), rng.integers(1, 30, size)
        terms = np.array([f"{x:05d}".encode() for x in rng.permutation(size)], dtype=object)
        for k in (1, 3, 10):
            want = {
                i for i in range(size)
                if sum(n[j] >= n[i] and lang_n[j] <= lang_n[i] and terms[j] < terms[i] for j in range(size)) < k
            }
            assert set(skyband(n, lang_n, terms, k).tolist()) == want
