import base64
import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from threadloom.llm import fingerprints as fp

FLAT = np.arange(fp.LEVELS + 1)


def slow_level(window):
    counts = np.array([window.count(b) for b in set(window)])
    total = sum(int(round((1 << 16) * c * np.log2(c))) for c in counts)
    return int(np.clip(np.round((1 - total / ((1 << 16) * fp.WINDOW * np.log2(fp.WINDOW))) * fp.LEVELS), 0, fp.LEVELS))


@settings(max_examples=50, deadline=None)
@given(st.binary(min_size=30, max_size=120), st.sampled_from([2, 5, 256]))
def test_levels(data, letters):
    data = bytes(b % letters for b in data)
    want = [slow_level(data[i:i + fp.WINDOW]) for i in range(len(data) - fp.WINDOW + 1)]
    assert fp.entropy_levels(np.frombuffer(data, np.uint8)).tolist() == want


def slow_digest(text, ranks):
    """Span by span, without arrays."""
    levels = fp.entropy_levels(np.frombuffer(text, np.uint8))
    points = {}
    for start in range(-fp.SPAN, len(levels)):
        span = [(int(ranks[levels[i]]), i) for i in range(max(0, start), min(len(levels), start + fp.SPAN))]
        if span:
            points[min(span)[1]] = points.get(min(span)[1], 0) + 1
    return sorted(i for i, n in points.items() if n >= fp.POINTS)


def test_digest_is_of_the_text_alone():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 97 + k, n, dtype=np.uint8)) for k, n in ((4, 500), (20, 90), (20, 3000), (9, 31), (9, 32), (1, 0), (20, 20000))]
    ranks = fp.ranks_of(fp.level_counts(texts))
    together = fp.digests(texts, ranks)
    assert together == [fp.digests([t], ranks)[0] for t in texts]
    assert fp.digests(texts[::-1], ranks) == together[::-1]
    data = np.frombuffer(texts[2], np.uint8)
    assert together[2] == fp.bloom_chain(fp.feature_hashes(data, np.array(slow_digest(texts[2], ranks))))
    assert together[5] == b"" and len(together[6]) > fp.BITS // 8


def test_likeness():
    rng = np.random.default_rng(2)
    a = bytes(rng.integers(97, 123, 6000, dtype=np.uint8))
    b = bytes(rng.integers(97, 123, 6000, dtype=np.uint8))
    half = a[:3000] + b[:3000]
    pa, pb, ph = fp.digests([a, b, half], FLAT)
    assert fp.likeness(pa, pa) == 1.0 and fp.likeness(pa, pb) < 0.1
    assert 0.3 < fp.likeness(pa, ph) < 0.8 and fp.likeness(pa, ph) == fp.likeness(ph, pa)
    assert fp.likeness(b"", b"") == 1.0 and fp.likeness(b"", pa) == 0.0


@pytest.mark.parametrize("tasks", [1, 3, 7])
def test_documents(spark, tasks):
    rng = np.random.default_rng(3)
    texts = {i: "".join(rng.choice(list("abcdé fgh\n"), int(n))) for i, n in enumerate(rng.integers(0, 400, 40))}
    texts |= {100: None, 101: "", 102: "x" * 300_000, None: "no id"}
    rows = [(i, t, "clash", False) for i, t in texts.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, bucket string, extra boolean")
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    try:
        out = {r.doc_id: r for r in fp.fingerprint_documents(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(out) == len(texts)
    ranks = fp.ranks_of(fp.level_counts([(t or "").encode() for t in texts.values()]))
    order = sorted((i for i in texts if i is not None), reverse=True) + [None]
    for i, j in zip(order, order[1:] + order[:1]):
        here, following = texts[i] or "", texts[j] or ""
        k = len(here) // 2
        changed = here[:len(here) - k] + following[:k]
        prints = fp.digests([here.encode(), changed.encode(), following.encode()], ranks)
        r = out[i]
        assert r.n_chars == len(here) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert [base64.b64decode(r.fingerprint), base64.b64decode(r.edited_fingerprint)] == prints[:2]
        assert r.near_edited == fp.likeness(prints[0], prints[1]) and r.near_next == fp.likeness(prints[0], prints[2])


def test_empty_and_single(spark):
    schema = "doc_id long, text string"
    assert fp.fingerprint_documents(spark.createDataFrame([], schema)).count() == 0
    r = fp.fingerprint_documents(spark.createDataFrame([(1, "abcd" * 50)], schema)).first()
    assert (r.near_next, r.n_chars) == (1.0, 200)
    twice = fp.fingerprint_documents(spark.createDataFrame([(1, "abcd" * 50), (1, "abcd" * 50), (1, "q")], schema)).collect()
    assert len(twice) == 3
