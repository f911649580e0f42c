"""Threads, their aggregates and transcripts."""

from pyspark.sql import functions as F

from threadloom.checks.message_queries import write_export
from threadloom.checks.registry import query
from threadloom.checks.views import (
    CONVERSATIONS_SQL,
    PLACED_SQL,
    REACTIONS_SQL,
    WEEK_SQL,
    conversation_messages,
    event_messages,
)
from threadloom.functions.reactions import top_reactions
from threadloom.lineage import cut, fresh_path
from threadloom.operators import rollups as R
from threadloom.operators import transcripts as X
from threadloom.operators.retrieval import headers
from threadloom.operators.threads import assign_threads
from threadloom.plans.etl import run_etl
from threadloom.sources.layers import read_layer
from threadloom.sources.versions import versions
from threadloom.streaming.stitcher import changed_threads, stitch_batch, stream_rollup, stream_threads, thread_index


def attached_events(t):
    """Messages stored once, as the messages layer is, with their threads."""
    return assign_threads(cut(event_messages(t), "messages"))


@query("thread_assignment", f"""
WITH RECURSIVE {PLACED_SQL} SELECT chat_id, message_id, root_id FROM placed
""")
def thread_assignment(t):
    return attached_events(t).select("chat_id", "message_id", "root_id")


ROLLUP_SQL = f"""
{PLACED_SQL}
, totals AS (
  SELECT chat_id, root_id, count(*) AS message_count, count(DISTINCT nullif(from_id, '')) AS participant_count,
    min(date_unixtime) AS start_unixtime, max(date_unixtime) AS end_unixtime
  FROM attached GROUP BY ALL HAVING count(*) >= 2)
, thread AS (
  SELECT t.chat_id || '_' || t.root_id AS thread_id, t.chat_id, r.chat_name,
    {WEEK_SQL.format(ts="make_timestamp(r.date_unixtime * 1000000)")} AS week_id,
    t.root_id AS root_message_id, message_count, participant_count, start_unixtime, end_unixtime
  FROM totals t JOIN msg r ON r.chat_id = t.chat_id AND r.message_id = t.root_id)
"""


@query("thread_rollup", f"WITH RECURSIVE {ROLLUP_SQL} SELECT * FROM thread")
def thread_rollup(t):
    return R.rollup_threads(attached_events(t))


@query("thread_velocity", f"""
WITH RECURSIVE {ROLLUP_SQL}
SELECT thread_id, round(CASE WHEN end_unixtime > start_unixtime
  THEN message_count / ((end_unixtime - start_unixtime) / 60.0) ELSE message_count END, 6) AS velocity
FROM thread
""")
def thread_velocity(t):
    rows = R.with_velocity(R.rollup_threads(attached_events(t)))
    return rows.select("thread_id", F.round("velocity", 6).alias("velocity"))


@query("dropped_threads", f"""
WITH RECURSIVE {PLACED_SQL}
SELECT count(*) FILTER (n < 2) AS single_message, count(*) FILTER (n >= 2 AND u > 0) AS undated_message
FROM (SELECT count(*) AS n, count(*) FILTER (message_id % 50 = 0) AS u
      FROM attached GROUP BY chat_id, root_id)
""")
def dropped_threads(t):
    """Every fiftieth message loses its date; threads that hold one are counted."""
    spoiled = F.when(F.col("message_id") % 50 != 0, F.col("date_unixtime"))
    return R.dropped_threads(attached_events(t).withColumn("date_unixtime", spoiled))


@query("reaction_counts", f"""
WITH RECURSIVE {REACTIONS_SQL}
SELECT chat_id, root_id, emoji, CAST(sum(cnt) AS BIGINT) AS total FROM rx GROUP BY ALL
""")
def reaction_counts(t):
    return R.reaction_counts(X.typed(attached_events(t)))


@query("reaction_summary", f"""
WITH RECURSIVE {REACTIONS_SQL}
, per AS (SELECT chat_id, root_id, emoji, CAST(sum(cnt) AS BIGINT) AS total FROM rx GROUP BY ALL)
SELECT chat_id, root_id, CAST(sum(total) AS BIGINT) AS total_count,
  string_agg(emoji, ' ' ORDER BY emoji) AS unique_emojis,
  string_agg(emoji || '=' || total, ' ' ORDER BY emoji) AS emoji_counts
FROM per GROUP BY ALL
""")
def reaction_summary(t):
    rows = R.reaction_summary(X.typed(attached_events(t)))
    entries = F.transform(
        F.sort_array(F.map_entries("emoji_counts")),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    return rows.select(
        "chat_id", "root_id", "total_count",
        F.array_join("unique_emojis", " ").alias("unique_emojis"),
        F.array_join(entries, " ").alias("emoji_counts"),
    )


@query("top_emojis", f"""
WITH RECURSIVE {REACTIONS_SQL}
SELECT * FROM (
  SELECT chat_id, root_id, emoji, total,
    row_number() OVER (PARTITION BY chat_id, root_id ORDER BY total DESC, emoji) AS rank
  FROM (SELECT chat_id, root_id, emoji, CAST(sum(cnt) AS BIGINT) AS total FROM rx GROUP BY ALL))
WHERE rank <= 3
""")
def top_emojis(t):
    return R.top_emojis(X.typed(attached_events(t))).withColumn("rank", F.col("rank").cast("bigint"))


TOP_RX_SQL = """
, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY chat_id, message_id ORDER BY cnt DESC, pos) AS place FROM rx)
, suffix AS (
  SELECT chat_id, message_id, ' {rxn: ' || string_agg(emoji || cnt, ' ' ORDER BY place) || '}' AS rxn
  FROM ranked WHERE place <= 2 GROUP BY ALL)
"""


@query("top_message_reactions", f"""
WITH RECURSIVE {REACTIONS_SQL} {TOP_RX_SQL}
SELECT chat_id, message_id, place, emoji, cnt AS total FROM ranked WHERE place <= 2
""")
def top_message_reactions(t):
    best = F.posexplode(top_reactions(F.col("reactions"))).alias("pos", "r")
    return X.typed(attached_events(t)).select("chat_id", "message_id", best).select(
        "chat_id", "message_id", (F.col("pos") + 1).cast("bigint").alias("place"),
        F.col("r.emoji").alias("emoji"), F.col("r.count").alias("total"),
    )


@query("participants", f"""
WITH RECURSIVE {PLACED_SQL}
SELECT chat_id, root_id, from_id,
  arg_max(sender, date_unixtime * 10000000 + message_id) FILTER (sender <> '') AS display_name,
  count(*) AS messages
FROM attached WHERE from_id <> '' GROUP BY ALL
""")
def participants(t):
    return R.participants(attached_events(t))


@query("nested_participants", f"""
WITH RECURSIVE {PLACED_SQL}
, p AS (
  SELECT chat_id, root_id, from_id,
    arg_max(sender, date_unixtime * 10000000 + message_id) FILTER (sender <> '') AS name
  FROM attached WHERE from_id <> '' GROUP BY ALL)
SELECT chat_id, root_id, string_agg(from_id, ' ' ORDER BY from_id) AS participant_ids,
  coalesce(string_agg(from_id || '=' || name, ' ' ORDER BY from_id) FILTER (name IS NOT NULL), '')
    AS participant_names
FROM p GROUP BY ALL
""")
def nested_participants(t):
    names = F.transform(
        F.sort_array(F.map_entries("participant_names")),
        lambda e: F.concat(e["key"], F.lit("="), e["value"]),
    )
    return R.nested_participants(attached_events(t)).select(
        "chat_id", "root_id", F.array_join("participant_ids", " ").alias("participant_ids"),
        F.array_join(names, " ").alias("participant_names"),
    )


EVENT_LINES_SQL = """
, line AS (
  SELECT chat_id, root_id, date_unixtime, message_id,
    coalesce(sender, 'Unknown') || ': ' || text || coalesce(rxn, '') AS said
  FROM attached LEFT JOIN suffix USING (chat_id, message_id))
"""
BASIC_SQL = """
SELECT thread_id, message_count, participant_count,
  '### CONVERSATION THREAD: ' || t.chat_name || chr(10) || '### METADATA: ' || message_count || ' msgs | '
  || CAST(floor((end_unixtime - start_unixtime) / 60.0) AS BIGINT) || ' mins duration' || chr(10)
  || '### TRANSCRIPT: ' || chr(10) || string_agg('['
  || strftime(make_timestamp(date_unixtime * 1000000), '%Y-%m-%d %H:%M') || '] ' || said, chr(10)
  ORDER BY date_unixtime, message_id) AS transcript
FROM thread t JOIN line l ON l.chat_id = t.chat_id AND l.root_id = t.root_message_id
GROUP BY thread_id, t.chat_name, message_count, participant_count, end_unixtime, start_unixtime
"""
GOLD_SQL = f"""
WITH RECURSIVE {REACTIONS_SQL.replace(PLACED_SQL, ROLLUP_SQL)} {TOP_RX_SQL} {EVENT_LINES_SQL} {BASIC_SQL}
"""


@query("thread_transcripts", GOLD_SQL)
def thread_transcripts(t):
    return X.gold_threads(attached_events(t)).select(
        "thread_id", "message_count", "participant_count", "transcript"
    )


CONVERSATION_THREADS_SQL = CONVERSATIONS_SQL + """
, thread AS (
  SELECT a.chat_id || '_' || a.root_id AS thread_id, a.chat_id, a.chat_name, a.root_id AS root_message_id,
    count(*) AS message_count, count(DISTINCT from_id) AS participant_count,
    min(date_unixtime) AS start_unixtime, max(date_unixtime) AS end_unixtime
  FROM attached a GROUP BY ALL HAVING count(*) >= 2)
, line AS (SELECT chat_id, root_id, date_unixtime, message_id, sender || ': ' || text AS said FROM attached)
"""


def conversation_threads(t, part_chars=X.PART_CHARS):
    return X.gold_threads(assign_threads(cut(conversation_messages(t), "messages")), part_chars)


def whole_transcripts(threads):
    """Transcripts of all parts joined in order."""
    parts = F.sort_array(F.collect_list(F.struct("part_no", "transcript")))
    return threads.groupBy("thread_id").agg(
        F.array_join(F.transform(parts, lambda p: p["transcript"]), "\n").alias("transcript")
    )


@query("conversation_transcripts", f"WITH RECURSIVE {CONVERSATION_THREADS_SQL} {BASIC_SQL}")
def conversation_transcripts(t):
    return conversation_threads(t).select(
        "thread_id", "message_count", "participant_count", "transcript"
    )


@query("gold_threads_in_parts", f"WITH RECURSIVE {CONVERSATION_THREADS_SQL} {BASIC_SQL}")
def gold_threads_in_parts(t):
    """Threads cut into small parts are whole when joined, and counted once."""
    threads = conversation_threads(t, part_chars=300)
    counts = headers(threads).select("thread_id", "message_count", "participant_count")
    return counts.join(whole_transcripts(threads), "thread_id")


@query("rich_transcripts", f"""
WITH RECURSIVE {REACTIONS_SQL.replace(PLACED_SQL, ROLLUP_SQL)} {TOP_RX_SQL} {EVENT_LINES_SQL}
, best AS (
  SELECT chat_id, root_id, string_agg(emoji || '(' || total || ')', ' ' ORDER BY place) AS shown FROM (
    SELECT *, row_number() OVER (PARTITION BY chat_id, root_id ORDER BY total DESC, emoji) AS place
    FROM (SELECT chat_id, root_id, emoji, CAST(sum(cnt) AS BIGINT) AS total FROM rx GROUP BY ALL))
  WHERE place <= 3 GROUP BY ALL)
SELECT thread_id,
  '### CONVERSATION THREAD: ' || t.chat_name || ' ' || chr(10) || '### METADATA: ' || message_count
  || ' msgs | ' || participant_count || ' participants | '
  || CAST(floor((end_unixtime - start_unixtime) / 60.0) AS BIGINT) || ' mins duration | thread_id: '
  || thread_id || chr(10) || coalesce('### SENTIMENT/REACTIONS: ' || shown, '### SENTIMENT: Neutral ')
  || chr(10) || '### TRANSCRIPT: ' || chr(10) || string_agg('['
  || strftime(make_timestamp(l.date_unixtime * 1000000), '%Y-%m-%d-%H-%M-%S') || '] ' || said, chr(10)
  ORDER BY l.date_unixtime, l.message_id) AS transcript
FROM thread t JOIN line l ON l.chat_id = t.chat_id AND l.root_id = t.root_message_id
LEFT JOIN best b ON b.chat_id = t.chat_id AND b.root_id = t.root_message_id
GROUP BY thread_id, t.chat_name, message_count, participant_count, end_unixtime, start_unixtime, shown
""")
def rich_transcripts(t):
    return X.rich_threads(attached_events(t)).select("thread_id", "transcript")


@query("rich_thread_records", f"""
WITH RECURSIVE {REACTIONS_SQL.replace(PLACED_SQL, ROLLUP_SQL)}
, per AS (SELECT chat_id, root_id, emoji, CAST(sum(cnt) AS BIGINT) AS total FROM rx GROUP BY ALL)
, emo AS (
  SELECT chat_id, root_id, CAST(sum(total) AS BIGINT) AS total_count, string_agg(emoji, ' ' ORDER BY emoji) AS unique_emojis,
    string_agg(emoji || '=' || total, ' ' ORDER BY emoji) AS emoji_counts FROM per GROUP BY ALL)
, named AS (
  SELECT chat_id, root_id, from_id, arg_max(sender, date_unixtime * 10000000 + message_id) FILTER (sender <> '') AS name
  FROM attached WHERE from_id <> '' GROUP BY ALL)
, people AS (
  SELECT chat_id, root_id, string_agg(from_id, ' ' ORDER BY from_id) AS participant_ids,
    coalesce(string_agg(from_id || '=' || name, ' ' ORDER BY from_id) FILTER (name IS NOT NULL), '') AS participant_names
  FROM named GROUP BY ALL)
SELECT thread_id, message_count, participant_count, coalesce(p.participant_ids, '') AS participant_ids,
  coalesce(p.participant_names, '') AS participant_names, coalesce(total_count, 0) AS total_count,
  coalesce(unique_emojis, '') AS unique_emojis, coalesce(emoji_counts, '') AS emoji_counts
FROM thread t LEFT JOIN people p ON p.chat_id = t.chat_id AND p.root_id = t.root_message_id
LEFT JOIN emo e ON e.chat_id = t.chat_id AND e.root_id = t.root_message_id
""")
def rich_thread_records(t):
    attached = cut(attached_events(t), "attached")
    records = X.rich_records(X.rich_threads(attached, stored=True), attached)

    def pairs(column):
        return F.array_join(F.transform(F.sort_array(F.map_entries(column)), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), " ")

    return records.select(
        "thread_id", "message_count", "participant_count", F.array_join("participant_ids", " ").alias("participant_ids"),
        pairs("participant_names").alias("participant_names"), F.col("reaction_summary.total_count").alias("total_count"),
        F.array_join("reaction_summary.unique_emojis", " ").alias("unique_emojis"),
        pairs("reaction_summary.emoji_counts").alias("emoji_counts"),
    )


@query("message_payload", f"""
WITH RECURSIVE {ROLLUP_SQL}
SELECT thread_id, row_number() OVER (PARTITION BY thread_id ORDER BY a.date_unixtime, a.message_id) AS position,
  a.message_id, a.date, a.sender, a.from_id, a.text, a.reply_to_message_id, a.date_unixtime,
  a.n_reactions
FROM thread t JOIN attached a ON a.chat_id = t.chat_id AND a.root_id = t.root_message_id
""")
def message_payload(t):
    """The JSON payload of each thread, read back into rows."""
    threads = X.messages_json(X.gold_threads(attached_events(t)))
    entry = (
        "array<struct<message_id:bigint,date:string,sender:string,from_id:string,text:string,"
        "reply_to_message_id:bigint,date_unixtime:bigint,reactions:array<struct<emoji:string,count:bigint>>>>"
    )
    rows = threads.select(
        "thread_id", F.posexplode(F.from_json("messages_json", entry)).alias("pos", "m")
    )
    return rows.select(
        "thread_id", (F.col("pos") + 1).cast("bigint").alias("position"), "m.message_id", "m.date",
        "m.sender", "m.from_id", "m.text", "m.reply_to_message_id", "m.date_unixtime",
        F.size("m.reactions").cast("bigint").alias("n_reactions"),
    )


@query("etl_threads", GOLD_SQL)
def etl_threads(t):
    """Export files → stored layers → the threads layer read back."""
    out = fresh_path(t.spark, "etl")
    run_etl(t.spark, write_export(t), None, out, multiline=False)
    return read_layer(t.spark, out, "threads").select(
        "thread_id", "message_count", "participant_count", "transcript"
    )


@query("etl_report", f"""
WITH RECURSIVE {PLACED_SQL}
, per_thread AS (SELECT count(*) AS n, count(*) FILTER (date_unixtime IS NULL) AS u FROM attached GROUP BY chat_id, root_id)
SELECT 'unreadable_documents' AS measure, 0 AS value
UNION ALL SELECT 'messages', count(*) FROM msg
UNION ALL SELECT 'without_id', count(*) FROM msg WHERE chat_id IS NULL OR message_id IS NULL
UNION ALL SELECT 'without_date', count(*) FROM msg WHERE date IS NULL
UNION ALL SELECT 'in_a_thread', count(*) FROM attached
UNION ALL SELECT 'single_message', count(*) FROM per_thread WHERE n < 2
UNION ALL SELECT 'undated_message', count(*) FROM per_thread WHERE n >= 2 AND u > 0
""")
def etl_report(t):
    """What an ETL run read, and what it left out and why."""
    out = fresh_path(t.spark, "etl")
    return run_etl(t.spark, write_export(t), None, out, multiline=False).report


def streamed(t, messages):
    """State after the stored ``messages`` went through the stream, one file per micro-batch."""
    path = messages.inputFiles()[0].rsplit("/", 1)[0]
    incoming = t.spark.readStream.schema(messages.schema).option("maxFilesPerTrigger", 1).parquet(path)
    state = fresh_path(t.spark, "stream-state")
    stream_threads(incoming, state, fresh_path(t.spark, "stream-progress"), buckets=4).awaitTermination()
    return state


@query("stream_threads", f"""
WITH RECURSIVE {PLACED_SQL} SELECT chat_id, message_id, root_id FROM placed
""")
def stream(t):
    """The messages in four files, newest first, one file per micro-batch."""
    messages = event_messages(t).select("chat_id", "message_id", "reply_to_message_id")
    ordered = cut(messages.repartitionByRange(4, F.desc("message_id")), "stream-source")
    return thread_index(t.spark, streamed(t, ordered))


def shuffled_stream(t):
    """Messages in any order, every fifth delivered a second time, and the last batch applied again."""
    messages = event_messages(t)
    again = messages.filter(F.xxhash64("message_id") % 5 == 0)
    rows = cut(messages.unionByName(again).repartition(3, F.xxhash64("message_id", F.rand(7))), "stream-source")
    state = streamed(t, rows)
    stitch_batch(rows, versions(t.spark, state)[-1], state)
    return state


@query("stream_rollup", f"WITH RECURSIVE {ROLLUP_SQL} SELECT * FROM thread")
def stream_rollup_query(t):
    return stream_rollup(t.spark, shuffled_stream(t))


@query("stream_changes", f"WITH RECURSIVE {ROLLUP_SQL} SELECT * FROM thread")
def stream_changes(t):
    """The last word of the feed on every thread is the roll-up."""
    feed = changed_threads(t.spark, shuffled_stream(t))
    last = feed.groupBy("thread_id").agg(F.max_by(F.struct(*feed.columns), "batch").alias("_")).select("_.*")
    return last.filter("is_thread").drop("batch", "undated", "is_thread")
