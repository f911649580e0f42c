"""One export document read in ranges, against Spark's own reader of whole files."""

import json
import random
from contextlib import suppress

import pytest

from threadloom.operators import messages as M
from threadloom.plans.etl import run_etl
from threadloom.sources import split_json as S
from threadloom.sources.exports import read_export
from threadloom.sources.layers import read_layer


def rows(df):
    """Texts that are JSON without their white space, which Spark's readers treat unlike."""
    out = []
    for r in df.collect():
        d = r.asDict(recursive=True)
        if (d["text"] or "")[:1] == "[":
            with suppress(ValueError):
                d["text"] = json.dumps(json.loads(d["text"]))
        out.append(json.dumps(d, sort_keys=True))
    return sorted(out)


def odd_text(rng):
    pieces = ["}", "{", '"', "\\", '\\"', "[", "]", ",", ":", "é", "\n", "messages", '"list": [', "a b", "}}}", ""]
    return "".join(rng.choice(pieces) for _ in range(rng.randrange(12)))


def document(rng):
    def message(i):
        m = {"id": i, "type": "message", "date": "2024-01-01T00:00:00", "from": odd_text(rng), "text": odd_text(rng)}
        if rng.random() < 0.3:
            m["text"] = [odd_text(rng), {"type": "link", "text": odd_text(rng)}]
        if rng.random() < 0.3:
            m["reactions"] = [{"emoji": "x", "count": rng.randrange(5)} for _ in range(rng.randrange(3))]
        if rng.random() < 0.3:
            m["other"] = {"messages": [{"id": 99, "text": odd_text(rng)}], "list": []}
        return m

    def chat(i):
        fields = [
            ("id", i), ("name", rng.choice([None, odd_text(rng)])), ("members", [{"id": 5, "messages": [{"id": 1}]}]),
            ("messages", [message(j) for j in range(rng.randrange(6))]), ("note", odd_text(rng)), ("about", {"list": [1], "chats": {}}),
        ]
        rng.shuffle(fields)
        return dict(fields)

    parts = [
        ("about", odd_text(rng)), ("contacts", {"list": [{"messages": [{"id": 7, "text": "no"}]}]}),
        ("chats", {"about": [{}], "list": [chat(i) for i in range(rng.randrange(1, 7))]}), ("list", [{"messages": [{"id": 8}]}]),
    ]
    rng.shuffle(parts)
    return dict(parts)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ranges_of_any_size(spark, tmp_path, seed):
    rng = random.Random(seed)
    for i in range(4):
        text = json.dumps(document(rng), indent=rng.choice([None, 1, 4]), ensure_ascii=rng.random() < 0.5)
        (tmp_path / f"{i}.json").write_text(text + rng.choice(["", "\n", " \n"]))
    want = rows(M.messages_of(M.chats_of(read_export(spark, str(tmp_path)))))
    for size in (100, 701, 1 << 20):
        assert rows(S.read_messages_split(spark, str(tmp_path), size)) == want


def test_one_file_is_several_tasks(spark, tmp_path):
    chat = {"id": 1, "name": "c", "messages": [{"id": i, "text": f"text {i}", "date": "2024-01-01T00:00:00", "from_id": "u"} for i in range(3000)]}
    path = tmp_path / "one.json"
    path.write_text(json.dumps({"chats": {"list": [chat]}}, indent=1))
    size = path.stat().st_size
    with S.settings(spark, {"spark.sql.files.maxPartitionBytes": str(size // 8), "spark.sql.files.openCostInBytes": str(size // 8)}):
        assert S._ranges(spark, str(path)).rdd.getNumPartitions() >= 8
    got = S.read_messages_split(spark, str(path), size // 8)
    assert sorted(r.id for r in got.select("id").collect()) == list(range(3000))
    assert {tuple(r) for r in got.select("chat_id", "chat_name").distinct().collect()} == {(1, "c")}
    result = run_etl(spark, str(path), ["c"], str(tmp_path / "out"), split=True)
    assert {r["layer"]: r["row_count"] for r in result.counts.collect()}["messages"] == 3000
    assert read_layer(spark, str(tmp_path / "out"), "messages").count() == 3000


def test_small_ranges_share_tasks(spark, tmp_path, monkeypatch):
    """A task per range of 64 KB cost more than reading it."""
    chats = [{"id": i, "name": f"chat {i}", "messages": [{"id": i, "text": 'a "}" b'}]} for i in range(4000)]
    path = tmp_path / "one.json"
    path.write_text(json.dumps({"chats": {"list": chats}}))
    tasks, summaries = [], S._summaries
    monkeypatch.setattr(S, "_summaries", lambda ranges: tasks.append(ranges.rdd.getNumPartitions()) or summaries(ranges))
    got = S.read_messages_split(spark, str(path), 1000)
    assert path.stat().st_size > 200_000 and tasks[0] <= 8 * spark.sparkContext.defaultParallelism
    assert sorted((r.chat_id, r.chat_name, r.id, r.text) for r in got.collect()) == [(i, f"chat {i}", i, 'a "}" b') for i in range(4000)]


def cut_up(spark, path, size):
    with S.settings(spark, {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": str(size)}):
        ranges = S._ranges(spark, str(path))
        return S._cut_out(ranges, S._beginnings(S._summaries(ranges))).collect()


def test_only_what_a_border_cuts_is_joined(spark, tmp_path):
    chats = [{"id": i, "messages": [{"id": j, "text": "x" * 50} for j in range(2)], "name": "c"} for i in range(500)]
    path = tmp_path / "one.json"
    path.write_text(json.dumps({"chats": {"list": chats}}))
    rows = cut_up(spark, path, 8000)
    whole, ranges = [r for r in rows if r.own], -(-path.stat().st_size // 8000)
    assert ranges > 5 and len(whole) >= 500 - ranges and all(len(r.texts) == 2 for r in whole)
    assert len(rows) - len(whole) <= 6 * ranges
    assert json.loads(whole[0].own) == {"id": 0, "messages": None, "name": "c"}


def test_chat_larger_than_what_is_held(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "HELD_BYTES", 300)
    chats = [{"messages": [{"id": 100 * i + j, "text": f"text {j}"} for j in range(i)], "id": i, "name": f"c{i}"} for i in range(30)]
    path = tmp_path / "one.json"
    path.write_text(json.dumps({"chats": {"list": chats}}))
    rows = cut_up(spark, path, 1 << 20)
    assert all(sum(map(len, r.texts[:-1])) <= 300 for r in rows if r.texts) and sum(r.own is not None for r in rows) < 29
    got = S.read_messages_split(spark, str(path), 1 << 20)
    assert sorted((r.chat_id, r.chat_name, r.id) for r in got.collect()) == [(i, f"c{i}", 100 * i + j) for i in range(30) for j in range(i)]
