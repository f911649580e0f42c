"""Threads from a stream: aggregates, feed of changes, bucketed state."""

import random
import re

import pytest
from pyspark.sql import functions as F

from threadloom.operators.rollups import participants, reaction_counts, rollup_threads
from threadloom.operators.threads import assign_threads
from threadloom.sources.versions import versions
from threadloom.streaming import state as S
from threadloom.streaming.stitcher import (
    SCHEMAS,
    changed_threads,
    pending_messages,
    stitch_batch,
    stream_participants,
    stream_reactions,
    stream_rollup,
    thread_index,
    _tables,
)

SCHEMA = (
    "chat_id bigint, message_id bigint, reply_to_message_id bigint, chat_name string, week_id string, sender string, "
    "from_id string, date_unixtime bigint, reactions array<struct<emoji:string,count:bigint>>, text string"
)


def message(rng, chat, m, parent):
    who = rng.choice([None, "", "u1", "u2", "u3"])
    return (
        chat, m, parent, f"chat {chat}", f"2024-{m % 50:02d}", rng.choice([None, "", "Ann", "Bo"]), who,
        None if rng.random() < 0.02 else rng.randrange(1000), [(rng.choice("xy"), rng.randrange(4)) for _ in range(rng.randrange(3))], "t",
    )


def forest(rng, chats=3, n=80):
    rows = []
    for chat in range(chats):
        ids = rng.sample(range(1, 1000), n)
        for i, m in enumerate(ids):
            dice = rng.random()
            parent = rng.choice([None, 0, -1]) if dice < 0.15 or not i else 5000 if dice < 0.2 else rng.choice(ids) if dice < 0.25 else ids[rng.randrange(i)]
            rows.append(message(rng, chat, m, parent))
    return rows


def same(left, right):
    def rows(df):
        return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)

    assert sorted(left.columns) == sorted(right.columns)
    assert rows(left) == rows(right)


def check(spark, rows, state):
    attached = assign_threads(spark.createDataFrame(rows, SCHEMA)).cache()
    same(thread_index(spark, state), attached.select("chat_id", "message_id", "root_id"))
    same(stream_rollup(spark, state), rollup_threads(attached))
    same(stream_participants(spark, state), participants(attached))
    same(stream_reactions(spark, state), reaction_counts(attached))
    return attached


@pytest.mark.parametrize("seed", [1])
def test_aggregates_equal_the_batch_for_any_order(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = forest(rng)
    rng.shuffle(rows)
    state = str(tmp_path / "state")
    cuts = sorted(rng.sample(range(len(rows)), 4))
    for b, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
        stitch_batch(spark.createDataFrame(rows[lo:hi], SCHEMA), b, state, buckets=4)
        stitch_batch(spark.createDataFrame(rows[lo:hi], SCHEMA), b, state)  # a replay
    stitch_batch(spark.createDataFrame(rows[:30], SCHEMA), 9, state)  # delivered again
    attached = check(spark, rows, state)
    assert pending_messages(spark, state).count() == len(rows) - attached.count()


def test_feed_of_changes(spark, tmp_path):
    rng = random.Random(5)
    state = str(tmp_path / "state")
    a, b, late, c = message(rng, 1, 1, None), message(rng, 1, 2, 1), message(rng, 1, 4, 3), message(rng, 1, 3, 1)
    a, b, late, c = (x[:7] + (i,) + x[8:] for i, x in enumerate((a, b, late, c)))
    other = message(rng, 2, 1, None)
    stitch_batch(spark.createDataFrame([a, other], SCHEMA), 0, state)
    stitch_batch(spark.createDataFrame([b, late], SCHEMA), 1, state)
    stitch_batch(spark.createDataFrame([c], SCHEMA), 2, state)
    feed = [(r.batch, r.thread_id, r.message_count, r.is_thread) for r in changed_threads(spark, state).orderBy("batch", "thread_id").collect()]
    assert feed == [(0, "1_1", 1, False), (0, "2_1", 1, False), (1, "1_1", 2, True), (2, "1_1", 4, True)]
    assert [r.message_count for r in changed_threads(spark, state, after=1).collect()] == [4]
    assert changed_threads(spark, str(tmp_path / "none")).isEmpty()


def test_a_wait_names_the_topmost_missing_message(spark, tmp_path):
    """A chain that arrives from its end, one message per batch, is placed at once when the root comes."""
    rng, state = random.Random(1), str(tmp_path / "state")
    rows = [message(rng, 1, m, m - 1 if m > 1 else None) for m in range(6, 0, -1)]
    for b, row in enumerate(rows[:-1]):
        stitch_batch(spark.createDataFrame([row], SCHEMA), b, state, buckets=2)
    assert {r.waits_for for r in pending_messages(spark, state).collect()} == {1}
    stitch_batch(spark.createDataFrame(rows[-1:], SCHEMA), 5, state)
    check(spark, rows, state)


def test_cycle_over_batches_and_what_answers_it(spark, tmp_path):
    rng, state = random.Random(1), str(tmp_path / "state")
    rows = [message(rng, 1, 1, 2), message(rng, 1, 2, 1), message(rng, 1, 3, 2), message(rng, 1, 4, None)]
    for b, row in enumerate(rows):
        stitch_batch(spark.createDataFrame([row], SCHEMA), b, state, buckets=2)
    check(spark, rows, state)
    assert pending_messages(spark, state).count() == 3


def test_a_batch_reads_only_touched_buckets(spark, tmp_path):
    rng, state = random.Random(3), str(tmp_path / "state")
    stitch_batch(spark.createDataFrame(forest(rng, 2, 200), SCHEMA), 0, state, buckets=64)
    t = _tables(spark, state, 1)
    asked = spark.createDataFrame([(0, 7)], "chat_id bigint, message_id bigint")
    buckets = t.touched(asked, "chat_id", "message_id")
    assert len(buckets) == 1
    read = {re.search(r"__bucket=(\d+)", f)[1] for f in t.read("index", buckets).inputFiles()}
    assert read <= {str(buckets[0])} and len(t.read("index").inputFiles()) > 50


def test_parts_stay_few_over_fifty_batches(spark, tmp_path):
    """Fan-in times levels bounds the parts of a bucket, whatever the number of batches."""
    state = str(tmp_path / "state")
    for batch in range(50):
        t = S.Tables(spark, state, {"sums": "k bigint, n bigint"}, {"sums": ["k"]}, batch, buckets=2)
        rows = spark.range(20).select(F.col("id").alias("k"), F.lit(1).cast("bigint").alias("n"))
        t.add({"sums": rows})
        t.merge({"sums": lambda rows, _: rows.groupBy("k").agg(F.sum("n").alias("n"))})
        t.commit()
        assert max(len(p) for p in t.parts["sums"].values()) <= 2 * S.FAN_IN
    t = S.Tables(spark, state, {"sums": "k bigint, n bigint"}, {"sums": ["k"]})
    assert t.read("sums").groupBy("k").agg(F.sum("n").alias("n")).filter("n = 50").count() == 20
    assert t.read("sums").count() < 20 * 2 * S.FAN_IN
    assert len(versions(spark, state)) == S.KEEP


def test_uncommitted_batch_leaves_the_state(spark, tmp_path):
    rng, state = random.Random(8), str(tmp_path / "state")
    rows = forest(rng, 1, 30)
    stitch_batch(spark.createDataFrame(rows[:20], SCHEMA), 0, state, buckets=2)
    before = sorted(map(tuple, thread_index(spark, state).collect()))
    t = _tables(spark, state, 1)
    t.add({"index": spark.createDataFrame([(9, 9, None, 9, None, 1)], SCHEMAS["index"])})
    assert sorted(map(tuple, thread_index(spark, state).collect())) == before  # died before its commit
    stitch_batch(spark.createDataFrame(rows[20:], SCHEMA), 1, state)
    check(spark, rows, state)


def test_without_dates_only_the_index_is_kept(spark, tmp_path):
    state = str(tmp_path / "state")
    stitch_batch(spark.createDataFrame([(1, 1, None), (1, 2, 1)], "chat_id bigint, message_id bigint, reply_to_message_id bigint"), 0, state)
    assert thread_index(spark, state).count() == 2 and stream_rollup(spark, state).isEmpty()
