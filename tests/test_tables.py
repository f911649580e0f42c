"""Stored layers, upserts, filters and samples."""

import pytest
from pyspark.sql import functions as F

from threadloom.lineage import cut, job
from threadloom.operators import retrieval as Q
from threadloom.operators.skew import broadcast_if_small
from threadloom.operators.threads import assign_threads
from threadloom.sources import layers as L
from threadloom.sources.exports import read_export, unreadable


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_write_layer(spark, tmp_path):
    base = str(tmp_path)
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert L.write_layer(None, base, "t") == 0
    assert L.write_layer(df, base, "t") == 2
    assert L.write_layer(df.filter("false"), base, "t") == 0
    assert L.read_layer(spark, base, "t").count() == 2
    # A layer may be replaced by rows read from itself.
    assert L.write_layer(L.read_layer(spark, base, "t").filter("k = 1"), base, "t") == 1
    L.append_layer(df.filter("k = 2"), base, "t")
    assert rows_of(L.read_layer(spark, base, "t")) == [(1, "a"), (2, "b")]
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("_staging")]


def test_failed_write_keeps_the_layer(spark, tmp_path):
    base = str(tmp_path)
    L.write_layer(spark.range(3), base, "t")
    broken = spark.range(3).select(F.raise_error(F.lit("broken")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="broken"):
        L.write_layer(broken, base, "t")
    assert L.read_layer(spark, base, "t").count() == 3


def test_write_all_and_store(spark, tmp_path):
    df = spark.range(4)
    counts = L.write_all(df, None, df.filter("id > 1"), str(tmp_path))
    assert rows_of(counts) == [("messages", 2), ("threads", 0), ("users", 4)]
    assert L.write_store(df, "noop") == 4
    assert L.write_store(None, "noop") == L.write_store(df.filter("false"), "noop") == 0


@pytest.mark.parametrize("small", [32 << 20, 0])
def test_upsert(spark, tmp_path, monkeypatch, small):
    """By broadcast and by shuffle."""
    monkeypatch.setattr(L, "BROADCAST_BYTES", small)
    base = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 0)], "k int, v string, x int")
    updates = spark.createDataFrame(
        [(2, None, 1), (2, "new", 2), (3, "c", 1), (None, "m", 1)], "k int, v string, at int"
    )
    got = L.upsert(base, updates, ["k"], [F.desc("at")]).select("k", "v", "x")
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(
        [(1, "a", 10), (2, "new", 20), (3, "c", None), (None, "m", 0)], key=str
    )
    first = L.upsert(base, updates, ["k"], [F.asc("at")]).filter("k = 2").first()
    assert first["v"] is None and first["x"] == 20
    assert L.upsert_layer(base, str(tmp_path), "t", ["k"]) == 3
    assert L.upsert_layer(updates.drop("at").filter("k = 3"), str(tmp_path), "t", ["k"]) == 4
    assert L.upsert_layer(updates, str(tmp_path), "first", ["k"]) == 3  # keys are unique from the start
    assert L.read_layer(spark, str(tmp_path), "first").filter("k = 2").first()["v"] == "new"


def test_find(spark):
    df = spark.createDataFrame([(i, f"t{i % 3}", i * 1.5) for i in range(10)], "_id int, g string, n double")
    assert Q.find(df).columns == ["g", "n"]
    top = Q.find(df, F.col("g") == "t0", ["_id"], sort_by="n", limit=2)
    assert [r[0] for r in top.collect()] == [9, 6]
    assert Q.find(df, F.col("n") > 5).count() == 6
    assert Q.find_one(df, F.col("g") == "t1", ["n"]).first()["n"] == 1.5
    assert Q.find_one(df, F.col("g") == "zz", ["n"]).isEmpty()
    assert Q.count(df, F.col("g") == "t2").first()[0] == 3


def test_samples(spark):
    df = spark.createDataFrame(
        [(i, None if i % 7 == 0 else "big" if i % 3 else "small") for i in range(300)], "id int, g string"
    )
    got = Q.stratified_sample(df, "g", ["id"], 4)
    assert rows_of(got.select("g", "id")) == [
        ("big", 1), ("big", 2), ("big", 4), ("big", 5), ("small", 3), ("small", 6), ("small", 9), ("small", 12),
    ]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # limited before and after the shuffle
    draw = Q.random_sample(df, ["id"], 50, "s")
    assert draw.count() == 50 and draw.distinct().count() == 50
    assert rows_of(draw.select("id")) == rows_of(Q.random_sample(df, ["id"], 50, "s").select("id"))
    assert rows_of(draw.select("id")) != rows_of(Q.random_sample(df, ["id"], 50, "u").select("id"))
    sliced = Q.group_slice(df.filter("g IS NOT NULL"), "g", [F.desc("id")], 2, ["id"])
    assert rows_of(Q.unwind(sliced)) == [(291,), (297,), (298,), (299,)]


def test_threads_to_load(spark):
    df = spark.createDataFrame([("a", "x", 5), ("b", "", 5), ("c", None, 5), ("d", "y", 4)],
                               "thread_id string, transcript string, message_count int")
    assert rows_of(Q.load_threads(df)) == [("a", "x"), ("d", "y")]
    assert rows_of(Q.load_threads(df, F.col("message_count") > 4)) == [("a", "x")]
    assert Q.larger_than(df, 4).count() == 3


def test_broadcast_only_when_small(spark):
    df = spark.range(50)
    assert "broadcast" in broadcast_if_small(df, 400)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in broadcast_if_small(df, 399)._jdf.queryExecution().logical().toString().lower()


def test_no_messages(spark):
    empty = spark.createDataFrame([], "chat_id bigint, message_id bigint, reply_to_message_id bigint")
    assert assign_threads(empty).isEmpty()


def test_jobs_leave_no_folder(spark):
    with job(spark):
        df = cut(spark.range(5), "kept-while-open")
        path = df.inputFiles()[0].rsplit("/", 1)[0]
        assert df.count() == 5 and L.path_exists(spark, path)
    assert not L.path_exists(spark, path)
    outside = cut(spark.range(2), "outside")
    with pytest.raises(ValueError):
        with job(spark):
            path = cut(spark.range(5), "failing").inputFiles()[0].rsplit("/", 1)[0]
            raise ValueError
    assert not L.path_exists(spark, path) and outside.count() == 2


def test_replaced_layer_leaves_nothing_behind(spark, tmp_path):
    for n in (3, 4):
        L.write_layer(spark.range(n), str(tmp_path), "t")
    broken = spark.range(3).select(F.raise_error(F.lit("broken")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="broken"):
        L.write_layer(broken, str(tmp_path), "t")
    assert [p.name for p in tmp_path.iterdir()] == ["t"] and L.read_layer(spark, str(tmp_path), "t").count() == 4


def test_sample_of_many_rows(spark, monkeypatch):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("g"))
    want = rows_of(Q.stratified_sample(df, "g", [F.desc("id")], 40))
    monkeypatch.setattr(Q, "LIMITED_RANK", 10)
    assert rows_of(Q.stratified_sample(df, "g", [F.desc("id")], 40)) == want and len(want) == 120


def test_large_samples_are_limited_before_the_shuffle(spark):
    """5,000 rows of one group of 400,000: each task sends on 5,000 at most."""
    df = spark.range(400_000, numPartitions=16).select(F.xxhash64("id").alias("v"), (F.col("id") % 1).alias("g"))
    before = spark.conf.get(Q.RANK_LIMIT)
    with Q._rank_limit(spark, 5000):
        salted = Q._first_ranks(df.withColumn("_salt", F.spark_partition_id() % 4), ["g", "_salt"], ["v"], 5000)
        plan = Q._first_ranks(salted.drop("_salt"), ["g"], ["v"], 5000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 3 and spark.conf.get(Q.RANK_LIMIT) == before
    got = [r.v for r in Q.stratified_sample(df, "g", ["v"], 5000).orderBy("v").collect()]
    assert got == [r.v for r in df.orderBy("v").limit(5000).collect()]


def test_unreadable_documents_are_listed(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"chats": {"list": []}}\n{"chats": broken\n')
    assert unreadable(spark, str(tmp_path), multiline=False).count() == 1
    assert read_export(spark, str(tmp_path), multiline=False).count() == 2


def data_files(folder):
    return {str(p.relative_to(folder)) for p in folder.rglob("part-*")}


def test_upsert_rewrites_only_touched_buckets(spark, tmp_path):
    base = spark.range(1000).select("id", F.concat(F.lit("v"), "id").alias("v"))
    assert L.upsert_layer(base, str(tmp_path), "t", ["id"], buckets=32) == 1000
    before = data_files(tmp_path / "t")
    updates = spark.createDataFrame([(3, "x"), (500, None), (5000, "new")], "id int, v string")
    assert L.upsert_layer(updates, str(tmp_path), "t", ["id"]) == 1001
    after = data_files(tmp_path / "t")
    assert before <= after  # the version before stays readable
    now = {f.split("/t/")[1] for f in L.read_layer(spark, str(tmp_path), "t").inputFiles()}
    assert len(before - now) <= 3 and len(now - before) <= 3
    got = dict(rows_of(L.read_layer(spark, str(tmp_path), "t")))
    assert len(got) == 1001 and (got[3], got[500], got[5000], got[4]) == ("x", None, "new", "v4")
    # New columns, other keys, appended rows.
    more = spark.createDataFrame([(4, 1.5)], "id bigint, w double")
    assert L.upsert_layer(more, str(tmp_path), "t", ["id"]) == 1001
    assert rows_of(L.read_layer(spark, str(tmp_path), "t").filter("w IS NOT NULL")) == [(4, "v4", 1.5)]
    assert L.append_layer(spark.createDataFrame([("a", 9999, None)], "v string, id int, w double"), str(tmp_path), "t") == 1
    assert L.upsert_layer(spark.createDataFrame([(9999, 2.5)], "id bigint, w double"), str(tmp_path), "t", ["id"]) == 1002
    assert rows_of(L.read_layer(spark, str(tmp_path), "t").filter("id = 9999")) == [(9999, "a", 2.5)]
    assert L.upsert_layer(spark.createDataFrame([("v4", 7.0)], "v string, w double"), str(tmp_path), "t", ["v"]) == 1002
    assert rows_of(L.read_layer(spark, str(tmp_path), "t").filter("id = 4")) == [(4, "v4", 7.0)]
    none = spark.createDataFrame([], "v string, w double")
    assert L.upsert_layer(none, str(tmp_path), "t", ["v"]) == 1002


def test_readers_pin_a_version(spark, tmp_path):
    base = str(tmp_path)
    L.write_layer(spark.range(3), base, "t")
    first, pinned = L.layer_version(spark, base, "t"), L.read_layer(spark, base, "t")
    L.write_layer(spark.range(10, 15), base, "t")
    L.append_layer(spark.range(1), base, "t")
    assert pinned.count() == 3 and L.read_layer(spark, base, "t", version=first).count() == 3
    assert L.read_layer(spark, base, "t").count() == 6
    for n in range(L.KEEP):
        L.write_layer(spark.range(n + 1), base, "t")
    with pytest.raises(ValueError):
        L.read_layer(spark, base, "t", version=first)
    assert len(list((tmp_path / "t").glob("data-*"))) == L.KEEP


def test_the_second_of_two_writers_fails(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    L.write_layer(spark.range(3), base, "t")
    seen = L.read_version(spark, f"{base}/t")
    L.write_layer(spark.range(4), base, "t")
    monkeypatch.setattr(L, "read_version", lambda *a: seen)
    with pytest.raises(OSError, match="another writer"):
        L.write_layer(spark.range(5), base, "t")
    monkeypatch.undo()
    assert L.read_layer(spark, base, "t").count() == 4 and len(list((tmp_path / "t").glob("data-*"))) == 2


def test_folders_without_versions(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "plain"))
    assert L.read_layer(spark, str(tmp_path), "plain").count() == 3
    with pytest.raises(ValueError, match="without versions"):
        L.append_layer(spark.range(1), str(tmp_path), "plain")
    with pytest.raises(ValueError, match="without versions"):
        L.upsert_layer(spark.range(1), str(tmp_path), "plain", ["id"])


def test_partitioned_layer(spark, tmp_path):
    L.write_layer(spark.range(9).withColumn("g", F.col("id") % 3), str(tmp_path), "t", partition_by=["g"])
    df = L.read_layer(spark, str(tmp_path), "t")
    assert df.filter("g = 1").count() == 3 and "g" in df.columns
    assert len(df.filter("g = 1").select("id").inputFiles()) >= 1
