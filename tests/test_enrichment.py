"""Model jobs, routing, taxonomy, triplets and graph."""

import json
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from threadloom.functions.text import contains_any
from threadloom.operators import graph as G
from threadloom.operators import routing, taxonomy, triplets
from threadloom.operators.models import failed, map_model, succeeded
from threadloom.operators.speakers import tag_speakers
from threadloom.plans.enrichment import run_enrichment

ANCHORED = "thread_id string, summary string, root string"


def rows_of(df):
    return {tuple(r) for r in df.collect()}


def test_map_model_keeps_failures_apart(spark):
    def half(row):
        if row["n"] % 2:
            raise ValueError("odd")
        return row["n"] // 2

    df = spark.range(10).select(F.col("id").alias("n"))
    results = map_model(df, half, ["n"], "bigint")
    assert rows_of(succeeded(results)) == {(n, n // 2) for n in range(0, 10, 2)}
    assert rows_of(failed(results)) == {(n, "ValueError: odd") for n in range(1, 10, 2)}


def test_routing(spark):
    lexicon = [("ROOT A", "Vote"), ("ROOT A", "party"), ("ROOT B", "trade"), ("ROOT C", "vote")]
    texts = {"a": "The VOTE of the party", "b": "trade and trade", "c": "vote", "d": "none"}
    df = spark.createDataFrame(list(texts.items()), "thread_id string, summary string")
    routed = routing.route_by_lexicon(df, lexicon).select("thread_id", "root")
    assert rows_of(routed) == {("a", "ROOT A"), ("b", "ROOT B"), ("c", "ROOT A"), ("d", "ROOT X")}

    answers = {
        "a": "<classification>ROOT G</classification>", "b": "ROOT B", "c": "<classification>B</classification>",
    }
    by_model = routing.route_by_model(df, lambda row: answers[row["thread_id"]])
    assert rows_of(by_model.select("thread_id", "root")) == {
        ("a", "ROOT G"), ("b", "ROOT X"), ("c", "ROOT X"), ("d", "ROOT X")
    }


def test_batches_cover_every_summary(spark):
    rows = [(f"t{i}", f"s{i}", "ROOT A" if i % 3 else "ROOT B") for i in range(1000)]
    df = spark.createDataFrame(rows, ANCHORED)
    batches = routing.group_by_root(df, batch=50).collect()
    seen = sorted((r["root_id"], s) for r in batches for s in r["summaries"])
    assert seen == sorted((root, s) for _, s, root in rows)
    assert max(len(r["summaries"]) for r in batches) < 100
    one = routing.group_by_root(df, batch=1000).collect()
    assert sorted(r["root_id"] for r in one) == ["ROOT A", "ROOT B"]


def test_taxonomy(spark):
    tree = "root_id string, domain string, topic string"
    current = spark.createDataFrame([("ROOT A", "old", "x"), ("ROOT B", "keep", "y")], tree)
    new = spark.createDataFrame([("ROOT A", "new", "z")], tree)
    assert rows_of(taxonomy.merge_taxonomy(current, new)) == {
        ("ROOT A", "new", "z"), ("ROOT B", "keep", "y")
    }

    def induce(row):
        if row["root_id"] == "ROOT B":
            raise RuntimeError("down")
        if row["root_id"] == "ROOT C":
            return []
        assert row["current_tree"] == [{"domain": "old", "topics": ["x"]}]
        return [{"domain": "d", "topics": ["first"]}, {"domain": "d", "topics": row["summaries"]},
                {"domain": "bare", "topics": []}]

    anchored = spark.createDataFrame(
        [("1", "s1", "ROOT A"), ("2", "s2", "ROOT A"), ("3", "s3", "ROOT B"), ("4", "s4", "ROOT C")],
        ANCHORED,
    )
    before = current.union(spark.createDataFrame([("ROOT C", "gone", "w")], tree))
    tree_after, lost = taxonomy.induce_taxonomy(anchored, before, induce)
    assert rows_of(tree_after) == {
        ("ROOT A", "d", "s1"), ("ROOT A", "d", "s2"), ("ROOT A", "bare", None),
        ("ROOT B", "keep", "y"),
    }
    assert rows_of(lost) == {("ROOT B", 0, "RuntimeError: down")}


def test_relation_lines(spark):
    lines = [
        "[A B] -> (led_to) -> [C]: why: because", "[A]->(p)->[B]", " [ A ] -> ( p ) -> [ B ] : \n c ",
        "A -> (p) -> [B]: x", "", None,
    ]
    df = spark.createDataFrame(
        [("t", json.dumps({"cross_domain_relationships": lines}), None), ("u", "no packet", "ROOT A"),
         ("v", json.dumps({"overarching_theme": "x"}), "ROOT A")], ANCHORED,
    )
    got = triplets.parse_relationships(df).orderBy("pos").collect()
    assert [tuple(r) for r in got] == [
        ("t", "General_Discourse", 0, "A B", "led_to", "C", "why: because"),
        ("t", "General_Discourse", 1, "A", "p", "B", ""),
        ("t", "General_Discourse", 2, "A", "p", "B", "c"),
    ]


def test_graph(spark):
    schema = (
        "seq bigint, thread_id string, topic string, subject string, predicate string, "
        "object string, context string"
    )
    rows = [
        (1, "t1", "T", " A ", "works with", "B\t", "old"),
        (2, "t2", "T", "A", "works-with", " B", " new "),
        (3, "t2", "T", "B", "soutient l'été", "A", None),
        (4, "t3", "T", "A", " ", "C", "skipped"), (5, "t3", "T", None, "p", "C", "skipped"),
    ]
    entities, edges = G.build_graph(spark.createDataFrame(rows, schema))
    expected = {
        ("A", "WORKS_WITH", "B", "t2", "T", "new"), ("B", "SOUTIENT_L__T_", "A", "t2", "T", ""),
    }
    assert rows_of(edges) == expected
    assert rows_of(entities) == {("A",), ("B",)}
    wanted = spark.createDataFrame([("t2",), ("t2",), ("t9",)], "id string")
    assert rows_of(G.triplets_by_threads(edges, wanted)) == {
        ("A", "works_with", "B", "new", "t2"), ("B", "soutient_l__t_", "A", "", "t2"),
    }
    assert G.triplets_by_threads(edges, wanted.filter("false")).isEmpty()
    stored = spark.createDataFrame(
        [("A", "WORKS_WITH", "B", "t0", "T", "stale"), ("X", "P", "Y", "t0", "T", "c")], edges.schema
    )
    merged = G.merge_edges(stored, spark.createDataFrame(rows, schema))
    assert rows_of(merged) == expected | {("X", "P", "Y", "t0", "T", "c")}


def test_speakers(spark):
    messages = spark.createDataFrame([("Ann", 1), ("Bob", 2), (None, 3)], "sender string, n int")
    ontology = spark.createDataFrame(
        [("Ann", "Finance Expert"), ("Ann", "Academic"), ("Ann", "Academic"), ("Eve", "Moderator")],
        "speaker string, role string",
    )
    got = {r["n"]: r["roles"] for r in tag_speakers(messages, ontology).collect()}
    assert got == {1: ["Academic", "Finance Expert"], 2: ["Participant"], 3: ["Participant"]}


def test_enrichment(spark):
    threads = spark.createDataFrame(
        [("1_1", "about trade", 40), ("1_2", "about votes", 40), ("1_3", "", 40), ("1_4", "short", 2)],
        "thread_id string, transcript string, message_count bigint",
    )

    def summarise(row):
        if "votes" in row["transcript"]:
            raise ValueError("refused")
        return json.dumps({"cross_domain_relationships": ["[Trade] -> (grows) -> [Market]: seen"]})

    def induce(row):
        return [{"domain": "Trade", "topics": ["Growth"]}]

    out = run_enrichment(
        threads, summarise, F.col("message_count") > 30, lexicon=[("ROOT C", "trade")], induce=induce
    )
    assert rows_of(out["anchored"].select("thread_id", "root")) == {("1_1", "ROOT C")}
    assert rows_of(out["taxonomy"]) == {("ROOT C", "Trade", "Growth")}
    assert rows_of(out["edges"]) == {("Trade", "GROWS", "Market", "1_1", "ROOT C", "seen")}
    assert rows_of(out["entities"]) == {("Trade",), ("Market",)}
    assert rows_of(out["failed"]) == {("1_2", "summary", "ValueError: refused")}

    def extract(row):
        return [{"subject": "S", "predicate": "p", "object": "O", "context": row["topic"]}]

    by_model = run_enrichment(
        threads, lambda row: "s", route=lambda row: "<classification>ROOT B</classification>", extract=extract
    )
    assert by_model["edges"].count() == 1  # one key, the last thread's properties
    assert by_model["edges"].first()["thread_id"] == "1_4"


def test_model_answers(spark):
    def fn(row):
        return {0: [1, 2], 1: None, 2: "text", 3: [1, "x"], 4: row}[row["i"]]

    rows = map_model(spark.range(5).withColumnRenamed("id", "i"), fn, ["i"], "array<bigint>").orderBy("i").collect()
    assert rows[0]["result"] == [1, 2] and rows[0]["error"] is None
    assert all(r["result"] is None and r["error"] for r in rows[1:])


def test_no_lexicon_and_no_words(spark):
    df = spark.createDataFrame([("1", "text")], "thread_id string, summary string")
    assert routing.route_by_lexicon(df, []).first()["root"] == "ROOT X"
    assert df.filter(contains_any(F.col("summary"), [])).isEmpty()


def test_combine_is_always_called(spark):
    threads = spark.createDataFrame(
        [("a", 0, 2, "x1", 9), ("a", 1, 2, "x2", 9), ("b", 0, 1, "y", 9), ("c", 0, 2, "z", 9), ("c", 1, 2, "bad", 9)],
        "thread_id string, part_no int, part_count int, transcript string, message_count bigint",
    )

    def summarise(row):
        if row["transcript"] == "bad":
            raise ValueError("no")
        return row["transcript"].upper()

    out = run_enrichment(threads, summarise, combine=lambda row: "+".join(row["parts"]))
    assert rows_of(out["summaries"].select("thread_id", "summary")) == {("a", "X1+X2"), ("b", "Y")}
    assert rows_of(out["failed"]) == {("c", "summary", "ValueError: no")}


def test_taxonomy_is_reduced_as_a_tree(spark):
    """Forty batches, four answers a call, three levels; one inner call of another root fails."""
    rows = [(f"t{i}", f"s{i}", root) for root in ("ROOT A", "ROOT B") for i in range(400)] + [("one", "s", "ROOT C")]
    anchored = spark.createDataFrame(rows, "thread_id string, summary string, root string")
    before = spark.createDataFrame([(r, "old", "x") for r in ("ROOT A", "ROOT B", "ROOT C", "ROOT D")], "root_id string, domain string, topic string")

    def induce(row):
        assert row["current_tree"] == []
        return [{"domain": "n", "topics": [f"{row['batch_no']}:{len(row['summaries'])}"]}]

    def combine(row):
        assert 1 <= len(row["partials"]) <= 4 and bool(row["current_tree"]) == row["is_last"]
        topics = [x for answer in row["partials"] for d in answer if d["domain"] == "n" for x in d["topics"]]
        if row["root_id"] == "ROOT B" and "17:" in " ".join(topics) and not row["is_last"]:
            raise ValueError("lost")
        return [{"domain": "n", "topics": topics}, {"domain": "old", "topics": [d["domain"] for d in row["current_tree"]]}]

    tree, lost = taxonomy.induce_taxonomy(anchored, before, induce, batch=10, combine=combine, fan_in=4)
    found = rows_of(tree)
    mine = [t for r, d, t in found if r == "ROOT A" and d == "n"]
    assert len(mine) > 30 and sum(int(x.split(":")[1]) for x in mine) == 400 and ("ROOT A", "old", "old") in found
    assert {x for x in found if x[0] in ("ROOT B", "ROOT D")} == {("ROOT B", "old", "x"), ("ROOT D", "old", "x")}
    assert {x for x in found if x[0] == "ROOT C"} == {("ROOT C", "n", "0:1"), ("ROOT C", "old", "old")}
    assert [tuple(r) for r in lost.collect()] == [("ROOT B", -1, "ValueError: lost")]


def test_model_calls_are_made_once_over_runs(spark, tmp_path):
    """A run whose task dies halfway, one that goes on, one with changed rows, one that retries errors."""
    from threadloom.operators.models import map_model_logged

    made, base = tmp_path / "made", str(tmp_path / "log")
    made.mkdir()
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(200)] + [(0, "t0")], "k bigint, text string").repartition(3)

    def run(df, dies=False, works=False, **more):
        def call(row):
            (made / f"{row['k']}-{row['text']}-{time.time_ns()}").touch()
            if dies and row["k"] == 150:
                raise KeyboardInterrupt
            if row["k"] % 50 == 7 and not works:
                raise ValueError("no")
            return row["text"].upper()

        out = map_model_logged(df, call, ["k"], "string", base, "calls", batches=5, **more)
        return sorted((r.k, r.result, r.error) for r in out.collect())

    with pytest.raises(Exception):
        run(rows, dies=True)
    first = run(rows)
    assert len(first) == 201 and first[0] == first[1] == (0, "T0", None) and first[8] == (7, None, "ValueError: no")
    calls = Counter(p.name.rsplit("-", 1)[0] for p in made.iterdir())
    assert len(calls) == 200 and sum(n > 1 for n in calls.values()) < 80  # one batch at most is called again
    n = sum(calls.values())
    assert run(rows) == first and len(list(made.iterdir())) == n  # nothing is left to call
    changed = rows.withColumn("text", F.when(F.col("k") == 3, "new").otherwise(F.col("text")))
    assert run(changed)[4] == (3, "NEW", None) and len(list(made.iterdir())) == n + 1
    assert run(rows, works=True, retry_errors=True)[8] == (7, "T7", None) and len(list(made.iterdir())) == n + 5
