import random
from collections import Counter

import numpy as np
import pytest

from threadloom.llm import sparse_suffix as ss
from threadloom.llm.common import table

SCHEMA = "doc_id long, text string, source string, start long, key long"


def brute(texts):
    """{(doc, start, words, source)} from all windows of all documents."""
    docs = [(i, (t or "").encode().split()) for i, t in texts]
    holders = {}
    for n, (i, w) in enumerate(docs):
        for k in range(len(w) - ss.LENGTH + 1):
            holders.setdefault(tuple(w[k:k + ss.LENGTH]), set()).add((i is None, n if i is None else i))
    out = set()
    for i, w in docs:
        run = []
        for k in range(len(w) - ss.LENGTH + 2):
            who = holders.get(tuple(w[k:k + ss.LENGTH]), ()) if k + ss.LENGTH <= len(w) else ()
            source = min((x for null, x in who if not null), default=None)
            if run and (len(who) < 2 or source != run[-1][1]):
                out.add((i, run[0][0], run[-1][0] - run[0][0] + ss.LENGTH, run[0][1]))
                run = []
            if len(who) > 1:
                run.append((k, source))
    return out


def result(spark, texts, df=None):
    df = df or spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in texts], SCHEMA)
    rows = ss.repeated_passages(df).collect()
    got = {(r.doc_id, r.start_word, r.n_words, r.source_id) for r in rows}
    assert len(got) == len(rows)
    return got


def corpus():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]

    def some(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    passages = [some(n) for n in (49, 50, 51, 60, 75, 120, 300)]
    texts = []
    for i in range(120):
        w = some(rng.randint(0, 80))
        for p in rng.sample(passages, rng.randint(0, 3)):
            a = rng.randint(0, len(p) // 4)
            w += (p if rng.random() < 0.5 else p[a:]) + some(rng.randint(0, 30))
        texts.append((i, rng.choice([" ", "\n", "  \t"]).join(w)))
    texts += [(200, texts[3][1]), (201, texts[3][1]), (202, None), (203, ""), (204, "x " * 5000), (205, "x " * 700)]
    return texts


@pytest.mark.parametrize("run", [8192, 3])
def test_against_brute_force(spark, monkeypatch, run):
    monkeypatch.setattr(ss, "RUN", run)
    monkeypatch.setattr(ss, "CHUNK", 100)
    texts = corpus()
    got, want = result(spark, texts), brute(texts)
    assert len(want) > 50 and got == want


def windows(words):
    return [tuple(words[k:k + ss.LENGTH]) for k in range(len(words) - ss.LENGTH + 1)]


def test_every_repeated_window_stays_in_its_source(spark):
    """Also where passages overlap: P and part of Q, P and Q, part of P and Q."""
    p, q = [f"p{i}" for i in range(80)], [f"q{i}" for i in range(80)]
    texts = corpus() + [(1000, " ".join(p + q[:30])), (1001, " ".join(p + q)), (1002, " ".join(p[-30:] + q)), (None, " ".join(["n"] + q))]
    left = {i: (t or "").split() for i, t in texts}
    drop, own = {i: set() for i in left}, {i: set() for i in left}
    for i, start, n, source in result(spark, texts):
        (own if source == i else drop)[i].update(range(start, start + n))
    kept = {i: [w for k, w in enumerate(words) if k not in drop[i] - own[i]] for i, words in left.items()}
    held = Counter(w for words in left.values() for w in set(windows(words)))
    stays = {w for words in kept.values() for w in windows(words)}
    assert {w for w, n in held.items() if n > 1} <= stays
    assert len(kept[1001]) < len(left[1001]) and kept[None] == ["n"]
    assert kept[1000] == left[1000] and kept[200] == kept[201] != left[200]



def test_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(spark, texts, docs) == brute(texts)


def test_shared_windows_share_a_minimiser():
    rng = np.random.default_rng(0)
    for _ in range(50):
        words = rng.integers(0, 2**63, 200, dtype=np.uint64)
        at, first, last = ss.minimisers(ss.gram_hashes(words))
        of = {k: p for p, a, b in zip(at.tolist(), first.tolist(), last.tolist()) for k in range(a, b + 1)}
        for k in range(len(words) - ss.LENGTH + 1):
            own, _, _ = ss.minimisers(ss.gram_hashes(words[k:k + ss.LENGTH]))
            assert len(own) == 1 and k + int(own[0]) == of[k]


def test_edge_cases(spark):
    assert result(spark, []) == set()
    long = " ".join(f"a{i}" for i in range(60))
    other = " ".join(f"b{i}" for i in range(60))
    assert result(spark, [(1, long), (1, long), (2, "short")]) == set()
    assert result(spark, [(1, f"{long} {other}"), (1, f"{other} {long}")]) == set()
    assert result(spark, [(None, long), (3, f"z {long}")]) == {(None, 0, 60, 3), (3, 1, 60, 3)}
    assert result(spark, [(None, long), (None, f"z {long}")]) == {(None, 0, 60, None), (None, 1, 60, None)}


def test_very_long_text(monkeypatch):
    """Pieces of any size give the places of the whole."""
    grams = np.random.default_rng(1).integers(0, 2**63, 5000, dtype=np.uint64)
    grams[100:400] = 5
    whole = [x.tolist() for x in ss.minimisers(grams)]
    monkeypatch.setattr(ss, "PIECE", 64)
    assert [x.tolist() for x in ss.minimisers(grams)] == whole
    monkeypatch.undo()
    many = np.random.default_rng(2).integers(0, 2**63, (1 << 24) + 5000, dtype=np.uint64)  # beyond 24 bits of places
    tail = (1 << 24) - 5000
    late, part = ss.minimisers(many)[0], ss.minimisers(many[tail:])[0] + tail
    assert late[late > tail + 100].tolist() == part[part > tail + 100].tolist()


def test_one_word_over_and_over(spark):
    """All places of such texts are one class."""
    docs = [(i, "x " * (500 + i)) for i in range(40)]
    assert {(i, k, n) for i, k, n, _ in result(spark, docs)} == {(i, 0, 500 + i) for i in range(40)}
