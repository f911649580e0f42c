import pytest

from threadloom.llm.curriculum import MixParams, mix_report, mixed_documents

SCHEMA = "doc_id long, text string, source string, size long, rank string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, 7, "x") for i, t, s in rows], SCHEMA)


def targets(sizes, weights, budget):
    """Round by round: share, stop at twice the size, share the excess again."""
    got, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    while open_ and budget > 1e-9:
        total = sum(weights[i] for i in open_)
        want = {i: got[i] + budget * weights[i] / total for i in open_}
        budget = 0.0
        for i in list(open_):
            if want[i] >= 2 * sizes[i]:
                budget += want[i] - 2 * sizes[i]
                got[i] = 2.0 * sizes[i]
                open_.discard(i)
            else:
                got[i] = want[i]
    return got


def test_targets_and_taken(spark):
    rows = [(i, "w " * (i % 9 + 1), f"s{(i % 7) ** 2 % 5}" if i % 11 else None) for i in range(300)]
    out = mix_report(docs(spark, rows)).collect()
    assert len(out) == 300
    names = sorted({s for *_, s in rows if s}) + [None]
    sizes = [sum(i % 9 + 1 for i, _, s in rows if s == n) for n in names]
    want = targets(sizes, [(3, 1, 2)[k % 3] for k in range(len(names))], 1.5 * sum(sizes))
    for n, z, w in zip(names, sizes, want):
        mine = [r for r in out if r.source == n]
        assert {r.source_size for r in mine} == {z}
        assert all(r.target == pytest.approx(w) for r in mine)
        assert abs(sum(r.taken for r in mine) - w) <= 0.5
    assert all(0 <= r.taken <= 2 * r.size and r.taken == r.words_1 + r.words_2 for r in out)
    assert all((r.first_position is None) == (r.words_1 == 0) for r in out)
    assert all(0 <= r.first_position <= 1 for r in out if r.first_position is not None)
    again = mix_report(docs(spark, rows[::-1])).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_schedule_shapes_positions(spark):
    rows = [(i, "w", s) for s in ("a", "b") for i in range(2000)]
    late = ((0.0, 0.5), (1.0, 1.5))
    p = MixParams(weights=(1.0, 1.0), share=1.0, schedules=(((0.0, 1.0), (1.0, 1.0)), late))
    out = mix_report(docs(spark, rows), p).collect()
    half = {s: sum(r.first_position < 0.5 for r in out if r.source == s and r.words_1) for s in ("a", "b")}
    assert abs(half["a"] - 1000) <= 1 and abs(half["b"] - 2000 * 0.375) <= 1


def test_edge_cases(spark):
    assert mix_report(docs(spark, [])).count() == 0
    out = mix_report(docs(spark, [(1, None, "a"), (2, "", None), (None, " \t", "a")])).collect()
    assert [(r.target, r.taken, r.first_position) for r in out] == [(0.0, 0, None)] * 3
    same = mix_report(docs(spark, [(5, "a b", "x")] * 4)).collect()
    assert sum(r.taken for r in same) == 12


def test_mixed_documents(spark):
    rows = [(i, f"  w{i} x\ty ", f"s{i % 3}") for i in range(30)] + [(99, None, "s0"), (98, "long " * 20000, "s1")]
    df = docs(spark, rows)
    taken = {r.doc_id: r for r in mix_report(df).collect()}
    out = mixed_documents(df)
    assert out.columns == df.columns
    words = {}
    texts = {i: t for i, t, _ in rows}
    for r in out.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
        assert texts[r.doc_id].startswith(r.text) and r.size == 7
    assert words == {i: r.taken for i, r in taken.items() if r.taken}


def test_more_than_two_runs_are_refused():
    with pytest.raises(ValueError, match="two runs"):
        MixParams(repeats=3)
