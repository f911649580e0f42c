"""Threads from a stream of messages that arrive in any order.

State is a set of bucketed tables (``state``), committed together once per batch:

* ``index``    every message seen: its root, or the missing ancestor it waits for;
* ``waiting``  the same waits, dealt by the awaited message, so that its arrival
  finds them; a wait names the topmost missing ancestor, never one that has arrived;
* ``held``     the other fields of messages that wait;
* ``totals``, ``people``, ``emojis``: partial aggregates per thread, per thread and
  author, per thread and emoji. Partial rows of any batches merge into one.

A batch reads the buckets of its messages, of their parents and of the threads it
changes. Late parents are normal: a message waits without limit, hence no watermark.
A batch that is committed is not applied again, and a message that is delivered
again is ignored. Messages on a cycle, and those that answer them, wait for ever.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from threadloom.lineage import cut, job, settings
from threadloom.operators.rollups import is_thread
from threadloom.operators.threads import attach, dedupe_messages, identified, parent_id, resolve_targets, thread_id
from threadloom.operators.transcripts import typed
from threadloom.schemas import REACTIONS
from threadloom.sources.versions import names, versions
from threadloom.streaming.state import BUCKETS, Tables

#: The folders of a few buckets are listed by the driver; above this many, a job does it.
LISTING = "spark.sql.sources.parallelPartitionDiscovery.threshold"

KEY = ["chat_id", "message_id"]
THREAD = ["chat_id", "root_id"]
#: Message fields that thread aggregates need; a stream without dates keeps none.
FACTS = {
    "chat_name": "string", "week_id": "string", "sender": "string", "from_id": "string",
    "date_unixtime": "bigint", "reactions": REACTIONS,
}
_LAST = "struct<date_unixtime:bigint,message_id:bigint,name:string>"
_ROOT = "struct<chat_name:string,week_id:string>"
_MESSAGE = "chat_id bigint, message_id bigint"
_THREAD = "chat_id bigint, root_id bigint"
SCHEMAS = {
    "index": f"{_MESSAGE}, reply_to_message_id bigint, root_id bigint, waits_for bigint, batch bigint",
    "waiting": f"{_MESSAGE}, reply_to_message_id bigint, waits_for bigint",
    "held": f"{_MESSAGE}, " + ", ".join(f"{c} {t}" for c, t in FACTS.items()),
    "totals": f"{_THREAD}, message_count bigint, start_unixtime bigint, end_unixtime bigint, undated bigint, root {_ROOT}",
    "people": f"{_THREAD}, from_id string, messages bigint, last {_LAST}",
    "emojis": f"{_THREAD}, emoji string, total bigint",
}
DEALT_BY = {
    "index": KEY, "waiting": ["chat_id", "waits_for"], "held": KEY, "totals": THREAD, "people": THREAD, "emojis": THREAD,
}


def _tables(spark: SparkSession, state: str, batch: int | None = None, buckets: int = BUCKETS) -> Tables:
    return Tables(spark, state, SCHEMAS, DEALT_BY, batch, buckets)


# Partial rows, and how several of a key become one.

def merge_index(rows: DataFrame) -> DataFrame:
    """The latest row of each message; a placed one stays placed."""
    rest = [c for c in rows.columns if c not in KEY]
    last = F.max_by(F.struct(*rest), F.struct(F.col("root_id").isNotNull(), "batch"))
    return rows.groupBy(*KEY).agg(last.alias("_")).select(*KEY, "_.*")


def partial_totals(placed: DataFrame) -> DataFrame:
    root = F.when(F.col("message_id") == F.col("root_id"), F.struct("chat_name", "week_id"))
    return placed.groupBy(*THREAD).agg(
        F.count("*").alias("message_count"), F.min("date_unixtime").alias("start_unixtime"),
        F.max("date_unixtime").alias("end_unixtime"), F.count_if(F.col("date_unixtime").isNull()).alias("undated"),
        F.max(root).alias("root"),
    )


def merge_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*THREAD).agg(
        F.sum("message_count").alias("message_count"), F.min("start_unixtime").alias("start_unixtime"),
        F.max("end_unixtime").alias("end_unixtime"), F.sum("undated").alias("undated"), F.max("root").alias("root"),
    )


def partial_people(placed: DataFrame) -> DataFrame:
    last = F.when(F.col("sender") != "", F.struct("date_unixtime", "message_id", F.col("sender").alias("name")))
    return placed.filter(F.col("from_id") != "").groupBy(*THREAD, "from_id").agg(
        F.count("*").alias("messages"), F.max(last).alias("last")
    )


def merge_people(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*THREAD, "from_id").agg(F.sum("messages").alias("messages"), F.max("last").alias("last"))


def partial_emojis(placed: DataFrame) -> DataFrame:
    each = placed.select(*THREAD, F.explode("reactions").alias("r"))
    return each.groupBy(*THREAD, F.col("r.emoji").alias("emoji")).agg(F.sum("r.count").alias("total"))


def merge_emojis(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*THREAD, "emoji").agg(F.sum("total").alias("total"))


AGGREGATES = {
    "totals": (partial_totals, merge_totals), "people": (partial_people, merge_people), "emojis": (partial_emojis, merge_emojis),
}


def stitch_batch(batch: DataFrame, batch_id: int, state: str, buckets: int = BUCKETS) -> None:
    """Place the batch and every waiting message it releases.

    ``buckets`` holds for a new state. What a batch writes besides the state is
    deleted when it ends.
    """
    if batch_id in versions(batch.sparkSession, state.rstrip("/")):
        return
    spark = batch.sparkSession
    with job(spark), settings(spark, {LISTING: "1000"}):
        _stitch(batch, _tables(spark, state, batch_id, buckets))


@dataclass
class Outcome:
    fresh: DataFrame  # new messages: KEY, reply_to_message_id, root_id or waits_for
    released: DataFrame  # earlier ones that waited for a new message, the same columns


def _stitch(batch: DataFrame, t: Tables) -> None:
    arrived = _arrived(batch)
    fresh = _fresh(arrived, t)
    outcome = _place(fresh, t)
    _remember(outcome, t)
    if "date_unixtime" in batch.columns:
        _aggregate(arrived, outcome, t)
    _merge(t)
    t.commit()


def _arrived(batch: DataFrame) -> DataFrame:
    rows = typed(identified(batch))
    facts = [F.col(c).cast(k).alias(c) if c in batch.columns else F.lit(None).cast(k).alias(c) for c, k in FACTS.items()]
    rows = dedupe_messages(rows.select(*KEY, "reply_to_message_id", *facts))
    return cut(rows.withColumn("parent", parent_id(F.col("reply_to_message_id"))), "arrived")


def _fresh(arrived: DataFrame, t: Tables) -> DataFrame:
    """New messages with ``to``, the message their placing depends on, and ``parent_root`` if that is known."""
    asked = arrived.select(*KEY).union(arrived.filter("parent IS NOT NULL").select("chat_id", "parent")).distinct()
    seen = t.read("index", t.touched(asked, *KEY)).join(asked, KEY, "left_semi")
    known = cut(merge_index(seen), "known")
    parents = known.select("chat_id", F.col("message_id").alias("parent"), F.col("root_id").alias("parent_root"), "waits_for")
    new = arrived.select(*KEY, "reply_to_message_id", "parent").join(known, KEY, "left_anti")
    return cut(
        new.join(parents, ["chat_id", "parent"], "left").select(
            *KEY, "reply_to_message_id", F.coalesce("waits_for", "parent").alias("to"), "parent", "parent_root"
        ),
        "fresh",
    )


def _place(fresh: DataFrame, t: Tables) -> Outcome:
    """Follow the new messages to their roots, or to the topmost ancestor that is missing."""
    settled = fresh.filter("parent_root IS NOT NULL").select("chat_id", F.col("parent").alias("message_id"), F.col("parent_root").alias("root_id")).distinct()
    # Whatever is neither new nor placed is missing; it takes the part of a root for now.
    missing = cut(
        fresh.filter("to IS NOT NULL AND parent_root IS NULL").select("chat_id", F.col("to").alias("message_id")).distinct()
        .join(fresh.select(*KEY), KEY, "left_anti"),
        "missing",
    )
    links = fresh.select(*KEY, F.col("to").alias("reply_to_message_id"))
    nodes = links.unionByName(missing.withColumn("reply_to_message_id", F.lit(None).cast("bigint")))
    found = attach(links, resolve_targets(nodes, settled)).select(*KEY, "root_id")
    missing = missing.select("chat_id", F.col("message_id").alias("root_id"), F.lit(True).alias("is_missing"))
    found = found.join(missing, ["chat_id", "root_id"], "left").select(
        *KEY, F.when(F.col("is_missing").isNull(), F.col("root_id")).alias("root_id"),
        F.when(F.col("is_missing"), F.col("root_id")).alias("waits_for"),
    )
    # Without a result: on a cycle, or above it. They wait for themselves, who will not come again.
    placed = fresh.select(*KEY, "reply_to_message_id").join(found, KEY, "left").withColumn(
        "waits_for", F.when(F.col("root_id").isNull(), F.coalesce("waits_for", "message_id"))
    )
    placed = cut(placed, "placed")
    came = placed.select("chat_id", F.col("message_id").alias("waits_for"), "root_id", F.col("waits_for").alias("next"))
    released = t.read("waiting", t.touched(came, "chat_id", "waits_for")).join(came, ["chat_id", "waits_for"]).filter(
        F.col("root_id").isNotNull() | (F.col("next") != F.col("waits_for"))
    )
    released = released.select(*KEY, "reply_to_message_id", "root_id", F.col("next").alias("waits_for"))
    return Outcome(placed, cut(released, "released"))


def _remember(outcome: Outcome, t: Tables) -> None:
    rows = outcome.fresh.unionByName(outcome.released)
    t.add({"index": rows.withColumn("batch", F.lit(t.batch)), "waiting": rows.filter("waits_for IS NOT NULL")})


def _aggregate(arrived: DataFrame, outcome: Outcome, t: Tables) -> None:
    """Add the placed messages to the aggregates of their threads, and list the changed threads."""
    facts = arrived.select(*KEY, *FACTS)
    free = outcome.released.filter("root_id IS NOT NULL").select(*KEY, "root_id")
    freed = t.read("held", t.touched(free, *KEY)).join(free, KEY)
    new = facts.join(outcome.fresh.filter("root_id IS NOT NULL").select(*KEY, "root_id"), KEY)
    placed = cut(new.unionByName(freed.select(*new.columns)), "placed-facts")
    t.add(
        {"held": facts.join(outcome.fresh.filter("waits_for IS NOT NULL"), KEY, "left_semi")}
        | {table: partial(placed) for table, (partial, _) in AGGREGATES.items()}
    )
    changed = cut(placed.select(*THREAD).distinct(), "changed")
    threads = _threads(t, t.touched(changed, *THREAD)).join(changed.withColumnRenamed("root_id", "root_message_id"), ["chat_id", "root_message_id"], "left_semi")
    threads.write.mode("overwrite").parquet(f"{t.path}/changes/batch={t.batch}")


def _merge(t: Tables) -> None:
    # Waits for messages that came were released then; fields of placed messages are in the aggregates.
    def came(buckets: list[int]) -> DataFrame:
        return t.read("index", buckets).select("chat_id", F.col("message_id").alias("waits_for")).distinct()

    def placed(buckets: list[int]) -> DataFrame:
        return t.read("index", buckets).filter("root_id IS NOT NULL").select(*KEY).distinct()

    t.merge({
        "index": lambda rows, _: merge_index(rows),
        "waiting": lambda rows, buckets: rows.join(came(buckets), ["chat_id", "waits_for"], "left_anti"),
        "held": lambda rows, buckets: rows.join(placed(buckets), KEY, "left_anti"),
    } | {table: (lambda rows, _, merged=merged: merged(rows)) for table, (_, merged) in AGGREGATES.items()})


def _threads(t: Tables, buckets: list[int] | None = None) -> DataFrame:
    """Aggregates of all threads (of these buckets), also of those with one message or undated ones."""
    authors = merge_people(t.read("people", buckets)).groupBy(*THREAD).agg(F.count("*").alias("participant_count"))
    rows = merge_totals(t.read("totals", buckets)).join(authors, THREAD, "left")
    return rows.select(
        thread_id(F.col("chat_id"), F.col("root_id")).alias("thread_id"), "chat_id", "root.chat_name", "root.week_id",
        F.col("root_id").alias("root_message_id"), "message_count",
        F.coalesce("participant_count", F.lit(0)).alias("participant_count"), "start_unixtime", "end_unixtime", "undated",
    )


def stream_threads(messages: DataFrame, state: str, checkpoint: str, buckets: int = BUCKETS, **trigger) -> StreamingQuery:
    """Start placing a stream of messages; ``trigger`` as for ``writeStream.trigger``."""
    return (
        messages.writeStream.foreachBatch(lambda df, batch_id: stitch_batch(df, batch_id, state, buckets))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def thread_index(spark: SparkSession, state: str) -> DataFrame:
    """(chat_id, message_id, root_id) of every message placed so far."""
    # A message is placed once, so its placed row is the only one with a root.
    return _tables(spark, state).read("index").filter("root_id IS NOT NULL").select(*KEY, "root_id")


def pending_messages(spark: SparkSession, state: str) -> DataFrame:
    """Messages that wait, with the missing ancestor they wait for."""
    latest = merge_index(_tables(spark, state).read("index"))
    return latest.filter("root_id IS NULL").select(*KEY, "reply_to_message_id", "waits_for")


def stream_rollup(spark: SparkSession, state: str) -> DataFrame:
    """``rollup_threads`` of all messages placed so far, from the stored aggregates."""
    return _threads(_tables(spark, state)).filter(is_thread()).drop("undated")


def stream_participants(spark: SparkSession, state: str) -> DataFrame:
    """``participants`` of all messages placed so far."""
    rows = merge_people(_tables(spark, state).read("people"))
    return rows.select(*THREAD, "from_id", F.col("last.name").alias("display_name"), "messages")


def stream_reactions(spark: SparkSession, state: str) -> DataFrame:
    """``reaction_counts`` of all messages placed so far."""
    return merge_emojis(_tables(spark, state).read("emojis"))


def changed_threads(spark: SparkSession, state: str, after: int = -1) -> DataFrame:
    """Feed of changes: threads as they were after each committed batch later than ``after`` that touched them.

    ``batch`` is the batch, ``is_thread`` whether the roll-up lists the thread at that time.
    """
    t = _tables(spark, state)
    done = [int(n.split("=")[1]) for n in names(spark, f"{t.path}/changes") if n.startswith("batch=")]
    folders = [f"{t.path}/changes/batch={b}" for b in sorted(done) if after < b <= (-1 if t.committed is None else t.committed)]
    kind = _threads(t, []).schema
    kind = kind.add("batch", "long")
    rows = spark.read.schema(kind).option("basePath", f"{t.path}/changes").parquet(*folders) if folders else spark.createDataFrame([], kind)
    return rows.withColumn("is_thread", is_thread())
