"""From nested export to flat, time-enriched messages and users."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from threadloom.functions.times import time_fields
from threadloom.lineage import cut
from threadloom.operators.skew import broadcast_if_small
from threadloom.schemas import LEFT_OUT, MESSAGE, RENAMED, USERS, holds_map

CHAT_LIST_LITERALS = 1_000  # longer chat lists go through a join


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def chats_of(export: DataFrame) -> DataFrame:
    """(chat_id, chat_name, messages), one row per chat; documents without chats vanish."""
    return export.select(F.inline("chats.list")).withColumnsRenamed({"id": "chat_id", "name": "chat_name"})


def keep_chats(chats: DataFrame, names: list[str] | DataFrame | None = None) -> DataFrame:
    """Chats with exactly these names; no names (``None`` or empty) keep all.

    ``names`` may also be a one-column DataFrame of any size.
    """
    if isinstance(names, DataFrame):
        if names.isEmpty():
            return chats
        # Chat rows carry all their messages: move the names, not the chats.
        wanted = broadcast_if_small(cut(names.toDF("chat_name").distinct(), "chat-names"))
        return chats.join(wanted, "chat_name", "left_semi")
    if not names:
        return chats
    if len(names) > CHAT_LIST_LITERALS:
        spark = chats.sparkSession
        return keep_chats(chats, spark.createDataFrame([(n,) for n in set(names)], "name string"))
    return chats.filter(F.col("chat_name").isin(list(names)))


def messages_of(chats: DataFrame) -> DataFrame:
    """One row per message: its chat, and the fields of the export as columns."""
    return chats.select("chat_id", "chat_name", F.inline("messages"))


def has_text(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def bronze_messages(export: DataFrame, names: list[str] | DataFrame | None = None) -> DataFrame:
    """Export → one row per message with text."""
    return messages_of(keep_chats(chats_of(export), names)).filter(has_text(F.col("text")))


def flatten_messages(bronze: DataFrame) -> DataFrame:
    """Messages under the declared flat schema, which names, types and orders the columns.

    ``id`` joins chat and message id; an id that is missing is passed over.
    """
    as_text = {f.name: F.to_json(f.name) for f in bronze.schema if holds_map(f.dataType)}
    rows = bronze.withColumns(as_text).withColumnsRenamed(RENAMED).drop(*LEFT_OUT)
    return rows.withColumn("id", F.concat_ws("_", "chat_id", "message_id")).to(MESSAGE)


def enrich_time(messages: DataFrame) -> DataFrame:
    """Add ``date_timestamp``, ``date_unixtime`` and ``week_id``; bad dates give NULL."""
    return messages.withColumns(time_fields(F.col("date")))


def user_names(messages: DataFrame) -> DataFrame:
    """(telegram_id, display_name, messages): every name that an author used, and how often."""
    named = messages.filter(F.col("from_id").isNotNull() & has_text(F.col("sender")))
    counted = named.groupBy("from_id", "sender").agg(F.count("*").alias("messages"))
    return counted.withColumnsRenamed({"from_id": "telegram_id", "sender": "display_name"})


def distinct_users(messages: DataFrame) -> DataFrame:
    """Distinct (id, name) pairs; a renamed user keeps one row per name."""
    return user_names(messages).to(USERS)


def dedupe(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """First row per key under ``order``.

    The rank filter is applied before the shuffle as well, so a key with many
    copies sends one row per input partition.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def user_documents(messages: DataFrame) -> DataFrame:
    """One document per user id, under the first name seen."""
    known = messages.filter(F.col("from_id").isNotNull())
    first = dedupe(
        known.select("from_id", "sender", "date_unixtime", "chat_id", "message_id"),
        ["from_id"],
        [F.col("date_unixtime").asc_nulls_last(), "chat_id", "message_id", "sender"],
    )
    return first.select(
        F.col("from_id").alias("telegram_id"),
        F.col("sender").alias("display_name"),
        F.lit(False).alias("is_bot"),
    )


def ingest_report(bronze: DataFrame) -> DataFrame:
    """Rows, rows without chat id, and chats found, in one pass."""
    return bronze.agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col("chat_id").isNull()).alias("null_ids"),
        F.count_distinct("chat_name").alias("found_chats"),
    )


def found_chats(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("chat_name").agg(F.count("*").alias("row_count"))


def missing_chats(requested: DataFrame, bronze: DataFrame) -> DataFrame:
    """Requested chat names (first column) that the data does not hold."""
    wanted = requested.select(F.col(requested.columns[0]).alias("chat_name")).distinct()
    return wanted.join(bronze.select("chat_name").distinct(), "chat_name", "left_anti")


def date_quality_report(enriched: DataFrame) -> DataFrame:
    counts = enriched.agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col("date_timestamp").isNull()).alias("failed_count"),
        F.min("date_timestamp").alias("min_date"),
        F.max("date_timestamp").alias("max_date"),
    )
    rate = F.when(F.col("row_count") > 0, F.col("failed_count") / F.col("row_count") * 100)
    return counts.select(
        "row_count",
        "failed_count",
        F.coalesce(rate, F.lit(0.0)).alias("failed_percent"),
        "min_date",
        "max_date",
        F.when(F.col("failed_count") > 0, "WARNING").otherwise("OK").alias("status"),
    )
