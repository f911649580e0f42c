"""Reading, flattening, time, users and reports."""

import ast

from pyspark.sql import functions as F

from threadloom.checks.registry import query
from threadloom.checks.views import MESSAGES_SQL, RAW_EVENTS_SQL, WEEK_SQL, event_messages, events_with_text, raw_events
from threadloom.functions.text import relation_name, strip
from threadloom.functions.times import RICH_STAMP, format_epoch
from threadloom.lineage import fresh_path
from threadloom.operators import messages as M
from threadloom.operators.threads import dedupe_messages, parent_lookup
from threadloom.schemas import RAW_MESSAGE, RENAMED
from threadloom.sources.exports import read_export
from threadloom.sources.split_json import read_messages_split


def write_export(t) -> str:
    """The events as export documents, one message per document, written by Spark."""
    chat = F.struct(
        F.col("chat_id").alias("id"), F.col("chat_name").alias("name"),
        F.array(F.struct(*RAW_MESSAGE.names)).alias("messages"),
    )
    document = F.struct(F.struct(F.array(chat).alias("list")).alias("chats"))
    path = fresh_path(t.spark, "export")
    raw_events(t).select(F.to_json(document).alias("value")).write.text(path)
    return path


EXPORT_SQL = f"""
WITH {RAW_EVENTS_SQL}
SELECT chat_id, chat_name, message_id,
  CASE WHEN event_type = 'signup' THEN 'service' ELSE 'message' END AS type,
  date, sender, from_id, text, reply_to_message_id, n_reactions
FROM raw
"""


@query("read_export", EXPORT_SQL)
def read_export_query(t):
    return _raw_fields(M.messages_of(M.chats_of(read_export(t.spark, write_export(t), multiline=False))))


def _raw_fields(rows):
    count = F.size("reactions").cast("bigint").alias("n_reactions")
    return rows.withColumnsRenamed(RENAMED).select("*", count).drop("reactions")


@query("read_export_split", EXPORT_SQL)
def read_export_split(t):
    """All events as one document in one file, read in ranges of 64 KB."""
    chat = F.struct(F.col("chat_id").alias("id"), F.col("chat_name").alias("name"), F.array(F.struct(*RAW_MESSAGE.names)).alias("messages"))
    lines = raw_events(t).select(F.concat(F.lit(", "), F.to_json(chat)).alias("value"))
    # An empty line makes sure that there is a first and a last one. One task writes the file; it needs no sort.
    lines = lines.unionByName(t.spark.range(1).select(F.lit("").alias("value"))).repartition(1).withColumn("at", F.monotonically_increasing_id())
    begins = F.when(F.col("at") == 0, '{"about": "{", "chats": {"list": [ {"messages": []}\n').otherwise("")
    ends = F.when(F.col("at") == t("events").count(), "\n]}}").otherwise("")
    path = fresh_path(t.spark, "export")
    lines.select(F.concat(begins, "value", ends).alias("value")).write.text(path)
    return _raw_fields(read_messages_split(t.spark, path, range_bytes=64 << 10))


@query("target_chats", f"""
WITH {RAW_EVENTS_SQL}
SELECT chat_id, chat_name, count(*) AS messages FROM raw
WHERE chat_name IN ('Chat 3', 'Chat 7') AND text <> '' GROUP BY ALL
""")
def target_chats(t):
    export = read_export(t.spark, write_export(t), multiline=False)
    rows = M.bronze_messages(export, ["Chat 3", "Chat 7", "Chat 99"])
    return rows.groupBy("chat_id", "chat_name").agg(F.count("*").alias("messages"))


@query("text_filter", f"""
WITH {MESSAGES_SQL} SELECT chat_id, message_id, text FROM msg
""")
def text_filter(t):
    return events_with_text(t).select("chat_id", F.col("id").alias("message_id"), "text")


@query("flatten_messages", f"""
WITH {MESSAGES_SQL}
SELECT chat_id || '_' || message_id AS id, message_id, chat_id, chat_name, date, sender, from_id, text,
  '[' || coalesce((SELECT string_agg('{{"emoji":"' || ['👍', '🔥', '😂', '❤', '🎉'][1 + (message_id + j) % 5]
      || '","count":"' || ((message_id * (j + 3)) % 17) || '","type":"emoji"}}', ',' ORDER BY j)
    FROM (VALUES (0), (1), (2)) n(j) WHERE j < n_reactions), '') || ']' AS reactions,
  reply_to_message_id
FROM msg
""")
def flatten(t):
    return M.flatten_messages(events_with_text(t))


SPOILED = """
spoiled AS (SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 'no date ' || event_id
    ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS date FROM events)
, timed AS (SELECT event_id, date, try_cast(date AS TIMESTAMP) AS ts FROM spoiled)
"""


def spoiled_dates(t):
    date = F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("no date "), "event_id")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    )
    return M.enrich_time(t("events").select("event_id", date.alias("date")))


@query("enrich_time", f"""
WITH {SPOILED}
SELECT event_id, date, CAST(epoch(ts) AS BIGINT) AS date_unixtime,
  {WEEK_SQL.format(ts="ts")} AS week_id
FROM timed
""")
def enrich_time(t):
    return spoiled_dates(t).select("event_id", "date", "date_unixtime", "week_id")


@query("week_ids", f"""
SELECT day, week_id, count(*) AS n FROM (
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, {WEEK_SQL.format(ts="o_orderdate")} AS week_id
  FROM orders) GROUP BY ALL
""")
def week_ids(t):
    from threadloom.functions.times import week_id

    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return (
        t("orders")
        .groupBy(day.alias("day"), week_id(F.col("o_orderdate").cast("timestamp")).alias("week_id"))
        .agg(F.count("*").alias("n"))
    )


@query("date_quality", f"""
WITH {SPOILED}
SELECT count(*) AS row_count, count(*) - count(ts) AS failed_count,
  round(100.0 * (count(*) - count(ts)) / count(*), 6) AS failed_percent,
  strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS min_date, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS max_date,
  CASE WHEN count(*) > count(ts) THEN 'WARNING' ELSE 'OK' END AS status
FROM timed
""")
def date_quality(t):
    report = M.date_quality_report(spoiled_dates(t))
    stamp = "yyyy-MM-dd HH:mm:ss"
    return report.select(
        "row_count", "failed_count", F.round("failed_percent", 6).alias("failed_percent"),
        F.date_format("min_date", stamp).alias("min_date"),
        F.date_format("max_date", stamp).alias("max_date"), "status",
    )


@query("require_columns", f"""
WITH {MESSAGES_SQL}
SELECT 'whole' AS checked, '' AS missing, count(*) AS rows FROM msg
UNION ALL SELECT 'without ids', 'message_id, reply_to_message_id', count(*) FROM msg
""")
def require_columns(t):
    """What the thread builder says about messages with and without the columns it needs."""
    messages, said = event_messages(t), None
    for name, df in (("whole", messages), ("without ids", messages.drop("message_id", "reply_to_message_id"))):
        missing = ""
        try:
            M.require_columns(df, ["chat_id", "message_id", "reply_to_message_id"])
        except ValueError as e:
            missing = ", ".join(ast.literal_eval(str(e).split(": ", 1)[1]))
        part = df.agg(F.lit(name).alias("checked"), F.lit(missing).alias("missing"), F.count("*").alias("rows"))
        said = part if said is None else said.unionByName(part)
    return said


@query("ingest_report", f"""
WITH {MESSAGES_SQL}
SELECT count(*) AS row_count, count(*) - count(chat_id) AS null_ids,
  count(DISTINCT chat_name) AS found_chats FROM msg
""")
def ingest_report(t):
    return M.ingest_report(events_with_text(t))


@query("missing_chats", """
SELECT 'Chat of user ' || c_custkey AS chat_name FROM customer
WHERE c_custkey NOT IN (SELECT user_id FROM events)
""")
def missing_chats(t):
    """One chat requested per customer; events hold the chats of their users."""
    def name(key):
        return F.concat(F.lit("Chat of user "), key).alias("chat_name")

    return M.missing_chats(
        t("customer").select(name("c_custkey")), t("events").select(name("user_id"))
    )


@query("distinct_users", f"""
WITH {MESSAGES_SQL}
SELECT DISTINCT from_id AS telegram_id, sender AS display_name FROM msg
WHERE from_id IS NOT NULL AND sender <> ''
""")
def distinct_users(t):
    return M.distinct_users(event_messages(t))


@query("user_documents", f"""
WITH {MESSAGES_SQL}
SELECT from_id AS telegram_id, sender AS display_name, false AS is_bot FROM (
  SELECT *, row_number() OVER (PARTITION BY from_id
    ORDER BY date_unixtime NULLS LAST, chat_id, message_id) AS rn FROM msg WHERE from_id IS NOT NULL)
WHERE rn = 1
""")
def user_documents(t):
    return M.user_documents(event_messages(t))


@query("dedupe_messages", f"""
WITH {MESSAGES_SQL}
SELECT chat_id, message_id, min(text) AS text, count(*) AS rows_left FROM (
  SELECT chat_id, message_id, text FROM msg) GROUP BY ALL
""")
def dedupe(t):
    """Every message twice, once with a longer text; one row per id is left."""
    once = event_messages(t).select("chat_id", "message_id", "text")
    twice = once.unionByName(once.withColumn("text", F.concat("text", F.lit("!"))))
    return dedupe_messages(twice).groupBy("chat_id", "message_id").agg(
        F.min("text").alias("text"), F.count("*").alias("rows_left")
    )


@query("parent_lookup", f"""
WITH {MESSAGES_SQL}
SELECT m.chat_id, m.message_id, m.parent AS parent_id, p.sender AS parent_sender, p.text AS parent_text
FROM msg m JOIN msg p ON m.chat_id = p.chat_id AND m.parent = p.message_id
""")
def parents(t):
    return parent_lookup(event_messages(t), ["sender", "text"]).select(
        "chat_id", "message_id", "parent_id", "parent_sender", "parent_text"
    )


@query("text_functions", """
SELECT p_partkey, p_name AS stripped,
  upper(regexp_replace(p_brand || ' é-' || p_type, '[^a-zA-Z0-9_]', '_', 'g')) AS relation,
  lower(p_brand) AS lowered
FROM part
""")
def text_functions(t):
    untidy = F.concat(F.lit(" \t "), "p_name", F.lit("  \n"))
    return t("part").select(
        "p_partkey",
        strip(untidy).alias("stripped"),
        relation_name(F.concat("p_brand", F.lit(" é-"), "p_type")).alias("relation"),
        F.lower("p_brand").alias("lowered"),
    )


@query("epoch_format", """
SELECT event_id, strftime(make_timestamp(CAST(epoch(date_trunc('second', ts)) * 1000000 AS BIGINT)),
  '%Y-%m-%d-%H-%M-%S') AS stamp FROM events
""")
def epoch_format(t):
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return t("events").select("event_id", format_epoch(seconds, RICH_STAMP).alias("stamp"))
