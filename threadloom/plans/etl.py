"""Export → messages, users and threads layers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from threadloom.lineage import cut, job
from threadloom.operators.messages import (
    bronze_messages,
    date_quality_report,
    distinct_users,
    enrich_time,
    flatten_messages,
    found_chats,
    has_text,
    keep_chats,
    missing_chats,
)
from threadloom.operators.rollups import dropped_threads
from threadloom.operators.threads import assign_threads
from threadloom.operators.transcripts import gold_threads, messages_json
from threadloom.sources.exports import is_unreadable, read_documents
from threadloom.sources.layers import read_layer, write_layer
from threadloom.sources.split_json import read_messages_split


@dataclass
class EtlResult:
    counts: DataFrame  # layer, row_count
    date_quality: DataFrame | None
    found_chats: DataFrame | None  # chat_name, row_count
    missing_chats: DataFrame | None = None  # requested chats without messages
    report: DataFrame | None = None  # what was read, what was left out and why, unreadable documents too


def etl_report(messages: DataFrame, attached: DataFrame) -> DataFrame:
    """(measure, value): messages, those without ids or thread, and dropped threads."""
    unnamed = F.col("chat_id").isNull() | F.col("message_id").isNull()
    read = messages.agg(
        F.count("*").alias("messages"), F.count_if(unnamed).alias("without_id"),
        F.count_if(F.col("date_timestamp").isNull()).alias("without_date"),
    )
    held = attached.agg(F.count("*").alias("in_a_thread"))
    parts = [df.unpivot([], df.columns, "measure", "value") for df in (read, held, dropped_threads(attached))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def run_etl(
    spark: SparkSession,
    path: str | list[str],
    chats: list[str] | DataFrame | None,
    out: str,
    multiline: bool = True,
    split: bool = False,
) -> EtlResult:
    """Read the export once, store the messages, derive the rest from the stored table.

    ``split`` reads each (valid, multi-line) document by many tasks.
    Intermediate tables are deleted when the run ends.
    """
    with job(spark):
        return _run_etl(spark, path, chats, out, multiline, split)


def _run_etl(
    spark: SparkSession, path: str | list[str], chats: list[str] | DataFrame | None, out: str, multiline: bool, split: bool
) -> EtlResult:
    seen = Observation()
    if split:
        bronze = keep_chats(read_messages_split(spark, path), chats).filter(has_text(F.col("text")))
    else:
        # Documents that cannot be read are counted while the messages are written.
        export = read_documents(spark, path, multiline).observe(seen, F.count_if(is_unreadable()).alias("unreadable"))
        bronze = bronze_messages(export, chats)
    silver = enrich_time(flatten_messages(bronze))
    if bronze.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism:
        # Fewer read tasks than cores: spread the rows before they are written.
        silver = silver.hint("rebalance")
    written = {"messages": write_layer(silver, out, "messages")}
    quality = found = missing = None
    rows = [("unreadable_documents", 0 if split else seen.get["unreadable"])]
    if written["messages"]:
        messages = read_layer(spark, out, "messages")
        quality, found = date_quality_report(messages), found_chats(messages)
        written["users"] = write_layer(distinct_users(messages), out, "users")
        attached = cut(assign_threads(messages), "attached")
        threads = messages_json(gold_threads(attached, stored=True))
        written["threads"] = write_layer(threads, out, "threads")
        rows += [tuple(r) for r in etl_report(messages, attached).collect()]  # one per measure
        if chats is not None and (isinstance(chats, DataFrame) or chats):
            wanted = chats if isinstance(chats, DataFrame) else spark.createDataFrame([(c,) for c in chats], "name string")
            missing = missing_chats(wanted, messages)
    report = spark.createDataFrame(rows, "measure string, value bigint")
    counts = [(n, written.get(n, 0)) for n in ("users", "threads", "messages")]
    return EtlResult(
        spark.createDataFrame(counts, "layer string, row_count bigint"), quality, found, missing, report
    )
