"""Gold threads: every thread with its transcript and message payload.

A thread is one or more rows (``part_no`` of ``part_count``) whose transcripts,
joined by a line break in order, are the whole transcript. The row with part 0 is
the thread's header: counts and filters on threads act on headers, and readers
take all parts of a thread (``retrieval.larger_than``, ``load_threads``). Parts
are cut by the characters of the thread alone, so they are the same in every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from threadloom.functions.reactions import parse_reactions, reaction_suffix
from threadloom.functions.times import BASIC_STAMP, RICH_STAMP, format_epoch, velocity, whole_minutes
from threadloom.lineage import cut
from threadloom.operators.messages import require_columns
from threadloom.operators.rollups import (
    KEYS,
    MIN_MESSAGES,
    nested_participants,
    reaction_summary,
    rollup_threads,
    top_emojis,
)
from threadloom.operators.threads import thread_id

PART_CHARS = 8_000_000  # characters of one gold row

# Transcript wording.
TITLE = "### CONVERSATION THREAD: "
METADATA = "### METADATA: "
SENTIMENT = "### SENTIMENT/REACTIONS: "
NEUTRAL = "### SENTIMENT: Neutral "
BODY = "### TRANSCRIPT: "
UNKNOWN_SENDER = "Unknown"

# Message fields of the payload, in order.
PAYLOAD = [
    "id", "message_id", "chat_id", "chat_name", "date", "sender", "from_id", "text",
    "reactions", "reply_to_message_id", "date_unixtime", "week_id",
]
GOLD = [
    "thread_id", "chat_id", "chat_name", "week_id", "root_message_id", "transcript", "messages",
    "message_count", "participant_count", "start_unixtime", "end_unixtime", "part_no",
    "part_count",
]


def typed(attached: DataFrame) -> DataFrame:
    """Reactions as typed arrays, parsed where they are still JSON text."""
    if dict(attached.dtypes).get("reactions") == "string":
        return attached.withColumn("reactions", parse_reactions(F.col("reactions")))
    return attached


def message_line(m: Column, stamp: str) -> Column:
    return F.concat(
        F.lit("["),
        format_epoch(m["date_unixtime"], stamp),
        F.lit("] "),
        F.coalesce(m["sender"], F.lit(UNKNOWN_SENDER)),
        F.lit(": "),
        F.coalesce(m["text"], F.lit("")),
        reaction_suffix(m["reactions"]),
    )


def basic_header() -> Column:
    minutes = whole_minutes(F.col("start_unixtime"), F.col("end_unixtime"))
    return F.concat(
        F.lit(TITLE), F.coalesce("chat_name", F.lit("None")), F.lit("\n" + METADATA),
        F.col("message_count").cast("string"), F.lit(" msgs | "),
        minutes.cast("string"), F.lit(" mins duration\n" + BODY),
    )


def rich_header() -> Column:
    minutes = whole_minutes(F.col("start_unixtime"), F.col("end_unixtime"))
    sentiment = F.when(F.col("sentiment") != "", F.concat(F.lit(SENTIMENT), F.col("sentiment")))
    return F.concat(
        F.lit(TITLE), F.coalesce("chat_name", F.lit("None")), F.lit(" \n" + METADATA),
        F.col("message_count").cast("string"), F.lit(" msgs | "),
        F.col("participant_count").cast("string"), F.lit(" participants | "),
        minutes.cast("string"), F.lit(" mins duration | thread_id: "), F.col("thread_id"),
        F.lit("\n"), F.coalesce(sentiment, F.lit(NEUTRAL)), F.lit("\n" + BODY),
    )


def _message() -> Column:
    # The two leading fields order a thread's messages; ids are unique in a chat.
    return F.struct("date_unixtime", "message_id", F.struct(*PAYLOAD).alias("m")).alias("_x")


def _collected(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key with its messages, not yet ordered, as ``_xs``."""
    return rows.groupBy(*keys).agg(F.collect_list(_message()).alias("_xs"))


def _in_order() -> Column:
    """Collected messages by time, then message id."""
    return F.transform(F.sort_array("_xs"), lambda x: x["m"]).alias("messages")


def _whole(rows: DataFrame) -> DataFrame:
    """Gold rows for threads that fit one row: a single aggregation, no join."""
    dated = ~F.exists("_xs", lambda x: x["date_unixtime"].isNull())
    kept = _collected(rows, KEYS).filter((F.size("_xs") >= MIN_MESSAGES) & dated)
    got = kept.select(*KEYS, _in_order())
    root = F.get(F.filter("messages", lambda m: m["message_id"] == F.col("root_id")), F.lit(0))
    authors = F.filter(F.transform("messages", lambda m: m["from_id"]), lambda a: a != "")
    return got.withColumn("_root", root).select(
        thread_id(F.col("chat_id"), F.col("root_id")).alias("thread_id"),
        "chat_id",
        F.col("_root.chat_name").alias("chat_name"),
        F.col("_root.week_id").alias("week_id"),
        F.col("root_id").alias("root_message_id"),
        "messages",
        F.size("messages").cast("bigint").alias("message_count"),
        F.size(F.array_distinct(authors)).cast("bigint").alias("participant_count"),
        F.get("messages", F.lit(0))["date_unixtime"].alias("start_unixtime"),
        F.element_at("messages", -1)["date_unixtime"].alias("end_unixtime"),
        F.lit(0).alias("part_no"),
        F.lit(1).alias("part_count"),
    )


def _in_parts(rows: DataFrame, part_chars: int) -> DataFrame:
    """Gold rows for large threads, cut by the thread's own cumulative characters.

    The sum goes by day first and within the day then, so no window holds a thread.
    """
    keys = [*KEYS, "_day"]
    rows = rows.withColumn("_day", F.floor(F.col("date_unixtime") / 86_400))
    days = rows.groupBy(*keys).agg(F.sum("_weight").alias("_w"))
    earlier = W.partitionBy(*KEYS).orderBy("_day").rowsBetween(W.unboundedPreceding, -1)
    days = days.withColumn("_before", F.coalesce(F.sum("_w").over(earlier), F.lit(0))).drop("_w")
    in_day = W.partitionBy(*keys).orderBy("date_unixtime", "message_id").rowsBetween(
        W.unboundedPreceding, 0
    )
    upto = F.col("_before") + F.sum("_weight").over(in_day) - 1
    cuts = rows.join(days, keys).withColumn("_cut", F.floor(upto / part_chars).cast("bigint"))
    parts = _collected(cuts, [*KEYS, "_cut"]).select(*KEYS, "_cut", _in_order())
    order = W.partitionBy(*KEYS).orderBy("_cut")
    numbers = (
        parts.select(*KEYS, "_cut")
        .withColumn("part_no", F.row_number().over(order) - 1)
        .withColumn("part_count", F.count("*").over(W.partitionBy(*KEYS)).cast("int"))
    )
    meta = rollup_threads(rows).withColumnRenamed("root_message_id", "root_id")
    return (
        parts.join(numbers, [*KEYS, "_cut"])
        .join(meta, KEYS)
        .withColumnRenamed("root_id", "root_message_id")
        .drop("_cut")
    )


def thread_parts(attached: DataFrame, part_chars: int = PART_CHARS, stored: bool = False) -> DataFrame:
    """Gold rows without transcript. Runs one narrow job to look for large threads.

    Sizes and rows are two reads of ``attached``. It is written for them, unless it is
    ``stored``: then its wide rows are not copied.
    """
    require_columns(attached, [*PAYLOAD, "root_id", "is_root"])
    weight = (
        F.coalesce(F.length("text"), F.lit(0)) + F.coalesce(F.length("sender"), F.lit(0)) + 64
    ).cast("bigint")
    rows = typed(attached).withColumn("_weight", weight)
    if not stored:
        rows = cut(rows, "attached")
    sizes = rows.groupBy(*KEYS).agg(F.sum("_weight").alias("_size"))
    large = cut(sizes.filter(F.col("_size") > part_chars), "large-threads-sizes")
    if large.isEmpty():
        return _whole(rows)
    # Large threads are at most (all characters / part_chars) keys; the planner
    # broadcasts them when their written size allows and shuffles otherwise.
    small = _whole(rows.join(large, KEYS, "left_anti"))
    big = _in_parts(cut(rows.join(large, KEYS, "left_semi"), "large-threads"), part_chars)
    return small.unionByName(big)


def with_sentiment(parts: DataFrame, attached: DataFrame) -> DataFrame:
    """Add the three most used emojis as ``emoji(count)`` text, '' without any."""
    shown = F.concat("emoji", F.lit("("), F.col("total").cast("string"), F.lit(")"))
    best = (
        top_emojis(typed(attached), 3)
        .groupBy(*KEYS)
        .agg(F.sort_array(F.collect_list(F.struct("rank", shown.alias("s")))).alias("_t"))
        .select(
            "chat_id",
            F.col("root_id").alias("root_message_id"),
            F.array_join(F.transform("_t", lambda t: t["s"]), " ").alias("sentiment"),
        )
    )
    return parts.join(best, ["chat_id", "root_message_id"], "left")


def render_transcripts(parts: DataFrame, rich: bool = False) -> DataFrame:
    """Add ``transcript``; the rich style needs ``sentiment``."""
    stamp = RICH_STAMP if rich else BASIC_STAMP
    lines = F.array_join(F.transform("messages", lambda m: message_line(m, stamp)), "\n")
    header = rich_header() if rich else basic_header()
    first = F.concat(header, F.lit("\n"), lines)
    return parts.withColumn("transcript", F.when(F.col("part_no") == 0, first).otherwise(lines))


def gold_threads(attached: DataFrame, part_chars: int = PART_CHARS, stored: bool = False) -> DataFrame:
    """Threads with basic transcripts and the message payload."""
    return render_transcripts(thread_parts(attached, part_chars, stored)).select(*GOLD)


def rich_records(threads: DataFrame, attached: DataFrame) -> DataFrame:
    """One record per thread of ``rich_threads``, with its people and reactions.

    Adds ``participant_ids``, ``participant_names`` (id → last name) and
    ``reaction_summary`` (total_count, unique_emojis, emoji_counts; of nothing: 0 and
    empty) to each header. They hold one entry per participant and emoji of the thread.
    """
    attached = typed(attached)
    summary = reaction_summary(attached).select(*KEYS, F.struct("total_count", "unique_emojis", "emoji_counts").alias("_s"))
    extra = nested_participants(attached).join(summary, KEYS, "full_outer").withColumnRenamed("root_id", "root_message_id")
    none = F.struct(
        F.lit(0).cast("bigint").alias("total_count"), F.array().cast("array<string>").alias("unique_emojis"),
        F.create_map().cast("map<string,bigint>").alias("emoji_counts"),
    )
    heads = threads.filter(F.col("part_no") == 0)
    return heads.join(extra, ["chat_id", "root_message_id"], "left").select(
        *heads.columns,
        F.coalesce("participant_ids", F.array().cast("array<string>")).alias("participant_ids"),
        F.coalesce("participant_names", F.create_map().cast("map<string,string>")).alias("participant_names"),
        F.coalesce("_s", none).alias("reaction_summary"),
    )


def rich_threads(attached: DataFrame, part_chars: int = PART_CHARS, stored: bool = False) -> DataFrame:
    """Threads with rich transcripts and their velocity."""
    attached = typed(attached)
    if not stored:
        attached = cut(attached, "attached")
    parts = with_sentiment(thread_parts(attached, part_chars, stored=True), attached)
    rate = velocity(F.col("message_count"), F.col("start_unixtime"), F.col("end_unixtime"))
    return render_transcripts(parts, rich=True).select(
        *GOLD, "sentiment", rate.alias("velocity")
    )


def messages_json(threads: DataFrame) -> DataFrame:
    """The payload as JSON text, as document stores take it."""
    return threads.withColumn("messages_json", F.to_json("messages")).drop("messages")
