"""Per-thread aggregates over messages that carry ``root_id``.

All of them aggregate before the shuffle, so one thread holding much of the data
sends one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from threadloom.functions.times import velocity
from threadloom.operators.threads import thread_id

KEYS = ["chat_id", "root_id"]
MIN_MESSAGES = 2  # fixed value: smaller threads are no conversation


def _thread_id():
    return thread_id(F.col("chat_id"), F.col("root_id")).alias("thread_id")


def thread_totals(attached: DataFrame, *more: Column) -> DataFrame:
    """Counts and time bounds of every thread, whatever its size, and ``more`` aggregates."""
    author = F.when(F.col("from_id") != "", F.col("from_id"))
    return attached.groupBy(*KEYS).agg(
        F.count("*").alias("message_count"),
        F.count_distinct(author).alias("participant_count"),
        F.min("date_unixtime").alias("start_unixtime"),
        F.max("date_unixtime").alias("end_unixtime"),
        F.count_if(F.col("date_unixtime").isNull()).alias("undated"),
        *more,
    )


def is_thread():
    return (F.col("message_count") >= MIN_MESSAGES) & (F.col("undated") == 0)


def rollup_threads(attached: DataFrame) -> DataFrame:
    """Threads of two or more messages with the root's chat name and week."""
    root = F.max(F.when(F.col("is_root"), F.struct("chat_name", "week_id")))
    totals = thread_totals(attached, root.alias("_root")).filter(is_thread() & F.col("_root").isNotNull())
    return totals.select(
        _thread_id(),
        "chat_id",
        "_root.chat_name",
        "_root.week_id",
        F.col("root_id").alias("root_message_id"),
        "message_count",
        "participant_count",
        "start_unixtime",
        "end_unixtime",
    )


def dropped_threads(attached: DataFrame) -> DataFrame:
    """How many threads are left out, and why."""
    return thread_totals(attached).agg(
        F.count_if(F.col("message_count") < MIN_MESSAGES).alias("single_message"),
        F.count_if((F.col("message_count") >= MIN_MESSAGES) & (F.col("undated") > 0)).alias(
            "undated_message"
        ),
    )


def with_velocity(threads: DataFrame) -> DataFrame:
    rate = velocity(F.col("message_count"), F.col("start_unixtime"), F.col("end_unixtime"))
    return threads.withColumn("velocity", rate)


def reaction_counts(attached: DataFrame) -> DataFrame:
    """(chat, root, emoji) → total; ``reactions`` are typed arrays."""
    each = attached.select(*KEYS, F.explode("reactions").alias("r"))
    return each.groupBy(*KEYS, F.col("r.emoji").alias("emoji")).agg(
        F.sum("r.count").alias("total")
    )


def reaction_summary(attached: DataFrame) -> DataFrame:
    """Total, distinct emojis and counts per emoji of every thread with reactions.

    The nested fields hold one entry per distinct emoji of the thread.
    """
    entry = F.struct("emoji", "total")
    return (
        reaction_counts(attached)
        .groupBy(*KEYS)
        .agg(F.sum("total").alias("total_count"), F.collect_list(entry).alias("_e"))
        .select(
            *KEYS,
            "total_count",
            F.sort_array(F.transform("_e", lambda e: e["emoji"])).alias("unique_emojis"),
            F.map_from_entries(F.sort_array("_e")).alias("emoji_counts"),
        )
    )


def top_emojis(attached: DataFrame, n: int = 3) -> DataFrame:
    """The n most used emojis per thread, ties in emoji order."""
    order = W.partitionBy(*KEYS).orderBy(F.desc("total"), F.asc("emoji"))
    return (
        reaction_counts(attached)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
    )


def participants(attached: DataFrame) -> DataFrame:
    """One row per thread and participant with the last non-empty name."""
    named = F.when(F.col("sender") != "", F.col("sender"))
    stamped = F.when(
        named.isNotNull(), F.struct("date_unixtime", "message_id", F.col("sender").alias("name"))
    )
    return (
        attached.filter(F.col("from_id") != "")
        .groupBy(*KEYS, "from_id")
        .agg(F.count("*").alias("messages"), F.max(stamped).alias("_last"))
        .select(*KEYS, "from_id", F.col("_last.name").alias("display_name"), "messages")
    )


def nested_participants(attached: DataFrame) -> DataFrame:
    """Participant id array and id→name map, one row per thread of any size.

    Nests all participants of a thread in its row; use ``participants`` where their
    number is unbounded.
    """
    entry = F.struct("from_id", "display_name")
    return (
        participants(attached)
        .groupBy(*KEYS)
        .agg(F.sort_array(F.collect_list(entry)).alias("_p"))
        .select(
            *KEYS,
            F.transform("_p", lambda p: p["from_id"]).alias("participant_ids"),
            F.map_from_entries(
                F.filter("_p", lambda p: p["display_name"].isNotNull())
            ).alias("participant_names"),
        )
    )
