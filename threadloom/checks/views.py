"""Chat-shaped views of the test tables, in Spark and in SQL.

Every view covers its whole table. The SQL forms are CTE bodies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.checks.registry import Tables
from threadloom.operators.messages import enrich_time, flatten_messages, has_text

EMOJIS = ["👍", "🔥", "😂", "❤", "🎉"]


def raw_events(t: Tables) -> DataFrame:
    """events as messages of chats, texts partly empty, replies in any order."""
    e = F.col("event_id")
    reply = (
        F.when(e % 7 == 0, F.lit(None).cast("bigint"))
        .when(e % 13 == 0, e + 20)
        .otherwise(e - 20 * (1 + e % 3))
    )
    emojis = F.array(*[F.lit(x) for x in EMOJIS])
    reactions = F.transform(
        F.slice(F.array(F.lit(0), F.lit(1), F.lit(2)), F.lit(1), (e % 4).cast("int")),
        lambda j: F.create_map(
            F.lit("emoji"), F.get(emojis, ((e + j) % 5).cast("int")),
            F.lit("count"), ((e * (j + 3)) % 17).cast("string"),
            F.lit("type"), F.lit("emoji"),
        ),
    )
    message = F.struct(
        e.alias("id"),
        F.when(F.col("event_type") == "signup", "service").otherwise("message").alias("type"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("date"),
        F.when(e % 19 == 0, F.lit(None)).when(e % 23 == 0, "").otherwise(
            F.concat(F.lit("User "), F.col("user_id"))
        ).alias("from"),
        F.when(e % 29 != 0, F.concat(F.lit("user"), F.col("user_id"))).alias("from_id"),
        F.when(e % 11 == 0, "").otherwise(
            F.concat_ws(" ", "event_type", F.col("value").cast("decimal(18,2)"), "props")
        ).alias("text"),
        reply.alias("reply_to_message_id"),
        reactions.alias("reactions"),
    )
    return t("events").select(
        (e % 20).alias("chat_id"),
        F.concat(F.lit("Chat "), (e % 20).cast("string")).alias("chat_name"),
        message.alias("m"),
    ).select("chat_id", "chat_name", "m.*")


RAW_EVENTS_SQL = """
raw AS (
  SELECT event_id % 20 AS chat_id, 'Chat ' || (event_id % 20) AS chat_name, event_id AS message_id,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') AS date,
    CAST(floor(epoch(date_trunc('second', ts))) AS BIGINT) AS date_unixtime,
    CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 23 = 0 THEN ''
         ELSE 'User ' || user_id END AS sender,
    CASE WHEN event_id % 29 <> 0 THEN 'user' || user_id END AS from_id,
    CASE WHEN event_id % 11 = 0 THEN ''
         ELSE event_type || ' ' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || ' ' || props
         END AS text,
    CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 13 = 0 THEN event_id + 20
         ELSE event_id - 20 * (1 + event_id % 3) END AS reply_to_message_id,
    event_id % 4 AS n_reactions, event_type
  FROM events)
"""

MESSAGES_SQL = RAW_EVENTS_SQL + """
, msg AS (
  SELECT *, CASE WHEN reply_to_message_id NOT IN (0, -1) THEN reply_to_message_id END AS parent
  FROM raw WHERE text <> '')
"""

PLACED_SQL = MESSAGES_SQL + """
, placed AS (
  SELECT chat_id, message_id, message_id AS root_id FROM msg WHERE parent IS NULL
  UNION ALL
  SELECT m.chat_id, m.message_id, p.root_id
  FROM msg m JOIN placed p ON m.chat_id = p.chat_id AND m.parent = p.message_id)
, attached AS (
  SELECT m.*, p.root_id FROM msg m JOIN placed p USING (chat_id, message_id))
"""

# One row per reaction of every message that is in a thread.
REACTIONS_SQL = PLACED_SQL + """
, rx AS (
  SELECT a.chat_id, a.message_id, a.root_id, j AS pos,
    ['👍', '🔥', '😂', '❤', '🎉'][1 + (a.message_id + j) % 5] AS emoji,
    (a.message_id * (j + 3)) % 17 AS cnt
  FROM attached a, (VALUES (0), (1), (2)) n(j) WHERE j < a.n_reactions)
"""

# Week id: Sunday-start weeks, week 1 holds 1 January, calendar year.
WEEK_SQL = """
CASE WHEN {ts} IS NULL THEN NULL ELSE
  CAST(year({ts}) AS VARCHAR) || '-' || lpad(CAST(
    CASE WHEN year(CAST({ts} AS DATE) + CAST(6 - dayofweek({ts}) AS INTEGER)) > year({ts}) THEN 1
    ELSE CAST(floor((dayofyear({ts}) - 1 + dayofweek(date_trunc('year', {ts}))) / 7.0) AS BIGINT) + 1
    END AS VARCHAR), 2, '0') END
"""


def event_messages(t: Tables) -> DataFrame:
    """raw_events as flat, time-enriched messages with text."""
    return enrich_time(flatten_messages(events_with_text(t)))


def events_with_text(t: Tables) -> DataFrame:
    return raw_events(t).filter(has_text(F.col("text")))


def conversation_messages(t: Tables) -> DataFrame:
    """conversations as messages: each turn replies to the one before."""
    epoch = F.lit(1_700_000_000) + F.col("conv_id") * 3600 + F.col("turn") * 60
    rows = t("conversations").select(
        F.concat_ws("_", F.col("conv_id"), F.col("turn") + 1).alias("id"),
        (F.col("turn") + 1).alias("message_id"),
        F.col("conv_id").alias("chat_id"),
        F.concat(F.lit("Conversation "), F.col("conv_id")).alias("chat_name"),
        F.date_format(F.timestamp_seconds(epoch), "yyyy-MM-dd'T'HH:mm:ss").alias("date"),
        F.col("role").alias("sender"),
        F.col("role").alias("from_id"),
        "text",
        F.lit(None).cast("string").alias("reactions"),
        F.when(F.col("turn") > 0, F.col("turn")).alias("reply_to_message_id"),
    )
    return enrich_time(rows.filter(has_text(F.col("text"))))


CONVERSATIONS_SQL = """
msg AS (
  SELECT conv_id AS chat_id, turn + 1 AS message_id, 'Conversation ' || conv_id AS chat_name,
    role AS sender, role AS from_id, text, CASE WHEN turn > 0 THEN turn END AS parent,
    1700000000 + conv_id * 3600 + turn * 60 AS date_unixtime
  FROM conversations WHERE text <> '')
, placed AS (
  SELECT chat_id, message_id, message_id AS root_id FROM msg WHERE parent IS NULL
  UNION ALL
  SELECT m.chat_id, m.message_id, p.root_id
  FROM msg m JOIN placed p ON m.chat_id = p.chat_id AND m.parent = p.message_id)
, attached AS (
  SELECT m.*, p.root_id FROM msg m JOIN placed p USING (chat_id, message_id))
"""


def line_triplets(t: Tables) -> DataFrame:
    """lineitem ⋈ supplier ⋈ part as triplets with untidy names and predicates."""
    pad = F.when(F.col("l_linenumber") % 2 == 0, "\t ").otherwise(" ")
    wide = (
        t("lineitem")
        .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    return wide.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        F.concat(F.lit("order "), "l_orderkey").alias("thread_id"),
        F.col("p_brand").alias("topic"),
        F.concat(pad, "s_name", F.lit(" ")).alias("subject"),
        F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"), " \t")
        .otherwise(F.concat(F.lit(" ships-é "), F.lower("p_type"), F.lit(".")))
        .alias("predicate"),
        F.concat("p_name", pad).alias("object"),
        F.concat(F.lit(" line "), "l_linenumber", F.lit(" qty "), F.col("l_quantity").cast("int"))
        .alias("context"),
    )


# The same triplets, cleaned; incomplete ones left out.
TRIPLETS_SQL = """
trip AS (
  SELECT l_orderkey * 10 + l_linenumber AS seq, 'order ' || l_orderkey AS thread_id,
    p_brand AS topic, s_name AS subject,
    upper(regexp_replace('ships-é ' || lower(p_type) || '.', '[^a-zA-Z0-9_]', '_', 'g')) AS predicate,
    p_name AS object,
    'line ' || l_linenumber || ' qty ' || CAST(l_quantity AS INTEGER) AS context
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
  WHERE NOT (l_returnflag = 'N' AND l_linestatus = 'F'))
, edge AS (
  SELECT subject, predicate, object, thread_id, topic, context FROM (
    SELECT *, row_number() OVER (PARTITION BY subject, predicate, object
      ORDER BY seq DESC, thread_id, topic, context) AS rn FROM trip) WHERE rn = 1)
"""

# Keywords for routing documents: invented word pieces of the test prose.
LEXICON = [
    ("ROOT A", "ering"), ("ROOT A", "there"), ("ROOT A", "ntion"),
    ("ROOT B", "eaux"), ("ROOT B", "oui"), ("ROOT B", "ment"),
    ("ROOT C", "und"), ("ROOT C", "schen"), ("ROOT C", "eiten"),
    ("ROOT D", "ción"), ("ROOT D", "ado"), ("ROOT D", "para"),
    ("ROOT E", "license"), ("ROOT E", "http"),
]


def document_summaries(t: Tables) -> DataFrame:
    return t("documents").select(
        F.concat(F.lit("doc "), "doc_id").alias("thread_id"), F.col("text").alias("summary")
    )


def _routed_sql() -> str:
    roots = list(dict.fromkeys(r for r, _ in LEXICON))
    scores = ", ".join(
        " + ".join(
            f"CAST(contains(lower(text), '{w}') AS INTEGER)" for r, w in LEXICON if r == root
        ) + f" AS n{i}"
        for i, root in enumerate(roots)
    )
    best = "greatest(" + ", ".join(f"n{i}" for i in range(len(roots))) + ")"
    cases = " ".join(f"WHEN n{i} = {best} THEN '{root}'" for i, root in enumerate(roots))
    return f"""
scored AS (SELECT 'doc ' || doc_id AS thread_id, text AS summary, lang, source, {scores} FROM documents)
, routed AS (
  SELECT thread_id, summary, lang, source,
    CASE WHEN {best} = 0 THEN 'ROOT X' {cases} END AS root FROM scored)
"""


ROUTED_SQL = _routed_sql()
