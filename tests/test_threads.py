"""Thread assignment: hand-made cases, and random forests against a plain walk."""

import random

import pytest
from pyspark.sql import functions as F

from threadloom.operators.rollups import dropped_threads, rollup_threads
from threadloom.operators.skew import most_frequent, salted, salts_for
from threadloom.operators.threads import assign_threads, resolve_targets
from threadloom.sources.layers import path_exists
from threadloom.streaming.stitcher import pending_messages, stitch_batch, thread_index

KEYS = "chat_id bigint, message_id bigint, reply_to_message_id bigint"


def walk(rows):
    """(chat, message) → root by following parents one at a time."""
    parent = {(c, m): (None if p in (None, 0, -1) else p) for c, m, p in rows}
    roots = {}
    for key in parent:
        seen, at = set(), key
        while at in parent and at not in seen and parent[at] is not None:
            seen.add(at)
            at = (at[0], parent[at])
        if at in parent and parent[at] is None:
            roots[key] = at[1]
    return roots


def assigned(spark, rows, **options):
    df = assign_threads(spark.createDataFrame(rows, KEYS), **options)
    got = df.select("chat_id", "message_id", "root_id").collect()
    assert len({(r[0], r[1]) for r in got}) == len(got)
    return {(r[0], r[1]): r[2] for r in got}


CASES = [
    (1, 1, None), (1, 2, 1), (1, 3, 2),  # chain
    (2, 1, None), (2, 2, 1), (2, 3, 1),  # branch
    (3, 5, None), (3, 2, 5), (3, 1, 2),  # late parent
    (4, 1, 0), (4, 2, -1), (4, 3, 1),  # parent ids that mean none
    (5, 2, 99), (5, 3, 2),  # missing parent
    (6, 1, 2), (6, 2, 1), (6, 3, 3),  # cycle, reply to itself
    (7, 1, None),  # single
    (8, 1, None), (8, 2, 1), (9, 1, None), (9, 2, 1),  # same ids in two chats
    (11, 1, 2), (11, 2, 1), (11, 3, 2), (11, 4, None), (11, 5, 4),  # cycle with a tail
]


def test_cases(spark):
    assert assigned(spark, CASES) == walk(CASES)
    assert (6, 1) not in walk(CASES) and (5, 3) not in walk(CASES)


def test_duplicates_and_null_ids(spark):
    rows = [(10, 1, None), (10, 1, None), (10, 2, 1), (None, 5, None), (10, None, 1)]
    assert assigned(spark, rows) == {(10, 1): 1, (10, 2): 1}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_forests(spark, seed):
    """Shuffled ids, orphans and cycles; small thresholds force the salted joins."""
    rng = random.Random(seed)
    rows = []
    for chat in range(4):
        ids = rng.sample(range(1, 5000), 400)
        for i, m in enumerate(ids):
            dice = rng.random()
            if dice < 0.1:
                rows.append((chat, m, rng.choice([None, 0, -1])))
            elif dice < 0.15:
                rows.append((chat, m, 9999))
            elif dice < 0.2:
                rows.append((chat, m, rng.choice(ids)))
            else:
                rows.append((chat, m, ids[rng.randrange(max(1, i))] if i else None))
    rng.shuffle(rows)
    expected = walk(rows)
    assert assigned(spark, rows) == expected
    assert assigned(spark, rows, hot_rows=5) == expected


def test_one_parent_holds_a_third(spark):
    """A hot parent is split over salts and the result stays whole."""
    rows = [(1, i, None if i == 1 else 1 if i % 3 else i - 1) for i in range(1, 3000)]
    df = spark.createDataFrame(rows, KEYS)
    targets = resolve_targets(df, hot_rows=100)
    assert targets.salts.agg(F.max("_salts")).first()[0] > 5
    assert assigned(spark, rows, hot_rows=100) == walk(rows)


def test_five_hundred_hot_parents(spark):
    """Any number of hot keys is salted: no part of a key is twice the median part."""
    replies = spark.range(500 * 300).select(
        (F.col("id") % 5).alias("chat_id"), (F.col("id") + 1000).alias("message_id"), (F.col("id") % 500 + 1).alias("parent_id")
    ).filter("parent_id <= 250 OR message_id DIV 500 % 2 = 0")
    on = ["chat_id", "parent_id"]
    salts = salts_for(replies, on, replies.agg(most_frequent(on)).first()[0], 100)
    assert salts.count() == 500
    parts = [r[0] for r in salted(replies, salts, on, ["message_id"]).groupBy(*on, "_salt").count().select("count").collect()]
    assert max(parts) <= 2 * sorted(parts)[len(parts) // 2]
    assert salts_for(replies, on, replies.agg(most_frequent(on)).first()[0], 400) is None
    rows = [(1, p, None) for p in range(1, 501)] + [(1, 1000 + i, i % 500 + 1) for i in range(5000)]
    assert assigned(spark, rows, hot_rows=5) == walk(rows)


def test_long_chain_takes_few_rounds(spark):
    rows = [(1, i, i - 1 if i > 1 else None) for i in range(1, 1500)]
    targets = resolve_targets(spark.createDataFrame(rows, KEYS))
    assert targets.rounds <= 12
    assert targets.roots.filter("root_id = 1").count() == 1498


def messages(spark, rows):
    return spark.createDataFrame(
        rows, KEYS + ", from_id string, sender string, date_unixtime bigint, chat_name string, "
        "week_id string",
    )


def test_rollup_and_drops(spark):
    rows = [
        (1, 1, None, "u1", "A", 60, "c", "2024-01"), (1, 2, 1, "u2", "B", 0, "c", "2024-02"),
        (1, 3, 1, None, "C", 30, "c", "2024-02"), (1, 4, 1, "", "D", 90, "c", "2024-02"),
        (2, 1, None, "u1", "A", 5, "d", "2024-01"),
        (3, 1, None, "u1", "A", 5, "e", "2024-01"), (3, 2, 1, "u1", "A", None, "e", "2024-01"),
    ]
    attached = assign_threads(messages(spark, rows))
    assert [tuple(r) for r in rollup_threads(attached).collect()] == [
        ("1_1", 1, "c", "2024-01", 1, 4, 2, 0, 90)
    ]
    assert tuple(dropped_threads(attached).first()) == (1, 1)


def test_stream_equals_batch_for_any_split(spark, tmp_path):
    rng = random.Random(7)
    rows = [(c, m, rng.choice([None, 0] + list(range(1, 60)))) for c in range(3) for m in range(1, 60)]
    rng.shuffle(rows)
    expected = walk(rows)
    state = str(tmp_path / "state")
    cuts = [0, 10, 90, 91, len(rows)]
    for b, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        stitch_batch(spark.createDataFrame(rows[lo:hi], KEYS), b, state)
        if b == 1:  # a replay must not change anything
            stitch_batch(spark.createDataFrame(rows[lo:hi], KEYS), b, state)
    # A message delivered again is not placed twice.
    stitch_batch(spark.createDataFrame(rows[:20], KEYS), len(cuts), state)
    got = thread_index(spark, state).collect()
    assert len(got) == len(expected)
    assert {(r[0], r[1]): r[2] for r in got} == expected
    assert pending_messages(spark, state).count() == len(rows) - len(expected)
    assert path_exists(spark, state)
    assert thread_index(spark, str(tmp_path / "none")).isEmpty()


def test_roots_are_marked(spark):
    df = assign_threads(spark.createDataFrame(CASES, KEYS))
    assert df.filter(F.col("is_root") != (F.col("message_id") == F.col("root_id"))).isEmpty()
