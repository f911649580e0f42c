"""Reply threads: which root does every message belong to?

Only messages that someone replies to take part in the iteration. Each round
replaces a message's pointer by its target's pointer, so pointers skip 2^k
ancestors after k rounds, in any arrival order and at any depth. Leaves join
their parent's root once at the end.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from threadloom.lineage import cut, fresh_path
from threadloom.operators.messages import dedupe, require_columns
from threadloom.operators.skew import HOT_ROWS, lookup, most_frequent, salts_for

# Parent ids that mean "no parent".
NO_PARENT = (0, -1)

# Pointers written by one round: those still open, and those settled in it.
STATE = "chat_id bigint, message_id bigint, ptr bigint, done boolean, round int"


def parent_id(reply_to: Column) -> Column:
    """Parent message id, NULL where the message starts a thread."""
    return F.when(~reply_to.isin(*NO_PARENT), reply_to)


def dedupe_messages(messages: DataFrame) -> DataFrame:
    """One row per (chat, message); the smallest row by its own content wins."""
    tie_break = [
        F.col(c).asc_nulls_last() for c in messages.columns if c not in ("chat_id", "message_id")
    ]
    return dedupe(messages, ["chat_id", "message_id"], tie_break or ["chat_id"])


def identified(messages: DataFrame) -> DataFrame:
    """Messages that carry both ids; the others can belong to no thread."""
    return messages.filter(F.col("chat_id").isNotNull() & F.col("message_id").isNotNull())


def unique_messages(messages: DataFrame) -> DataFrame:
    """``dedupe_messages`` that moves only the rows of repeated ids.

    A narrow count finds whether ids repeat; usually none does and the messages
    are returned as they are.
    """
    keys = ["chat_id", "message_id"]
    counts = messages.groupBy(*keys).agg(F.count("*").alias("_n"))
    if (counts.agg(F.max("_n")).first()[0] or 0) < 2:
        return messages
    repeated = cut(counts.filter(F.col("_n") > 1).select(*keys), "repeated-ids")
    once = messages.join(repeated, keys, "left_anti")
    return once.unionByName(dedupe_messages(messages.join(repeated, keys, "left_semi")))


def parent_lookup(
    messages: DataFrame, columns: list[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Each reply with its parent's ``columns`` (prefixed ``parent_``), same chat."""
    replies = messages.withColumn("parent_id", parent_id(F.col("reply_to_message_id"))).filter(
        F.col("parent_id").isNotNull()
    )
    parents = messages.select(
        "chat_id",
        F.col("message_id").alias("parent_id"),
        *[F.col(c).alias(f"parent_{c}") for c in columns],
    )
    on = ["chat_id", "parent_id"]
    salts = salts_for(replies, on, replies.agg(most_frequent(on)).first()[0], hot_rows)
    return lookup(replies, parents, on, salts, spread_by=["message_id"])


@dataclass
class ReplyTargets:
    """Thread root of every message that has replies."""

    roots: DataFrame  # chat_id, message_id, root_id
    salts: DataFrame | None = None  # hot parents (chat_id, _parent), for the final join
    rounds: int = 0


def _links(messages: DataFrame) -> DataFrame:
    return messages.select(
        "chat_id", "message_id", parent_id(F.col("reply_to_message_id")).alias("parent_id")
    )


def resolve_targets(
    messages: DataFrame, known: DataFrame | None = None, hot_rows: int = HOT_ROWS
) -> ReplyTargets:
    """Find the root of every replied-to message; ``messages`` has unique ids.

    ``known`` (chat_id, message_id, root_id) holds messages resolved earlier.
    Messages on a cycle or under a missing parent get no root.
    """
    links = _links(identified(messages))
    replies = links.filter(F.col("parent_id").isNotNull())
    answered = ["chat_id", "parent_id"]
    hot_parents = salts_for(replies, answered, replies.agg(most_frequent(answered)).first()[0], hot_rows)
    parents = replies.select("chat_id", F.col("parent_id").alias("message_id")).distinct()

    is_root = F.col("parent_id").isNull()
    state = links.join(parents, ["chat_id", "message_id"], "left_semi").select(
        "chat_id",
        "message_id",
        F.when(is_root, F.col("message_id")).otherwise(F.col("parent_id")).alias("ptr"),
        is_root.alias("done"),
    )
    if known is not None:
        wanted = known.join(parents, ["chat_id", "message_id"], "left_semi")
        state = state.unionByName(
            wanted.select(
                "chat_id", "message_id", F.col("root_id").alias("ptr"), F.lit(True).alias("done")
            )
        )

    waiting = ~F.col("done")
    folder = fresh_path(messages.sparkSession, "thread-state")

    def write(rows: DataFrame, number: int) -> dict:
        seen = Observation()
        rows.observe(
            seen,
            F.count_if(waiting).alias("open"),
            most_frequent(["chat_id", "ptr"], where=waiting).alias("hot"),
        ).write.parquet(f"{folder}/round={number}")
        return seen.get

    def written() -> DataFrame:
        return messages.sparkSession.read.schema(STATE).parquet(folder)

    seen, before, rounds = write(state, 0), -1, 0
    # Every round settles or drops at least one message that can be settled, so an
    # unchanged count means that only cycles are left.
    while seen["open"] and seen["open"] != before:
        # Rows settled in any round, and the latest pointers of the others.
        so_far, latest = written(), F.col("round") == rounds
        undone = so_far.filter(latest & waiting).select("chat_id", "message_id", "ptr")
        targets = so_far.filter(latest | F.col("done")).select(
            "chat_id",
            F.col("message_id").alias("ptr"),
            F.col("ptr").alias("next_ptr"),
            F.col("done").alias("next_done"),
        )
        salts = salts_for(undone, ["chat_id", "ptr"], seen["hot"], hot_rows)
        step = lookup(undone, targets, ["chat_id", "ptr"], salts, spread_by=["message_id"])
        rounds += 1
        before = seen["open"]
        seen = write(
            step.select(
                "chat_id", "message_id",
                F.col("next_ptr").alias("ptr"), F.col("next_done").alias("done"),
            ),
            rounds,
        )
    roots = written().filter("done").select("chat_id", "message_id", F.col("ptr").alias("root_id"))
    if hot_parents is not None:
        hot_parents = hot_parents.withColumnRenamed("parent_id", "_parent")
    return ReplyTargets(roots, hot_parents, rounds)


def attach(messages: DataFrame, targets: ReplyTargets) -> DataFrame:
    """Add ``root_id`` and ``is_root``; messages without a root are left out."""
    rows = identified(messages).withColumn("_parent", parent_id(F.col("reply_to_message_id")))
    starts = rows.filter(F.col("_parent").isNull()).select(
        "*", F.col("message_id").alias("root_id"), F.lit(True).alias("is_root")
    )
    found = targets.roots.select("chat_id", F.col("message_id").alias("_parent"), "root_id")
    replies = lookup(
        rows.filter(F.col("_parent").isNotNull()),
        found,
        ["chat_id", "_parent"],
        targets.salts,
        spread_by=["message_id"],
    ).withColumn("is_root", F.lit(False))
    return starts.unionByName(replies).drop("_parent")


def assign_threads(
    messages: DataFrame, unique_ids: bool = False, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Messages with ``root_id`` and ``is_root``.

    ``messages`` is read several times, so it should be a stored table. Pass
    ``unique_ids=True`` when (chat_id, message_id) is known to be unique.
    """
    require_columns(messages, ["chat_id", "message_id", "reply_to_message_id"])
    if not unique_ids:
        messages = unique_messages(identified(messages))
    return attach(messages, resolve_targets(messages, hot_rows=hot_rows))


def thread_id(chat: Column, root: Column) -> Column:
    return F.concat_ws("_", chat, root)
