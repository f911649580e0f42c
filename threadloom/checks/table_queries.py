"""Filters, samples, counts and stored layers."""

from pyspark.sql import functions as F

from threadloom.checks.registry import query
from threadloom.checks.thread_queries import (
    CONVERSATION_THREADS_SQL,
    conversation_threads,
    whole_transcripts,
)
from threadloom.checks.views import MESSAGES_SQL, event_messages
from threadloom.functions.text import contains_any
from threadloom.lineage import cut, fresh_path
from threadloom.operators import retrieval as Q
from threadloom.operators.messages import distinct_users
from threadloom.sources.exports import read_users_csv
from threadloom.sources.layers import (
    append_layer,
    export_csv,
    read_layer,
    upsert,
    upsert_layer,
    write_all,
    write_layer,
)


@query("document_filter", """
SELECT doc_id, lang, source, n_chars FROM documents
WHERE n_chars > 500 AND lang IN ('en', 'fr') AND source = 'src1' AND source IS NOT NULL
  AND regexp_matches(text, '(?i)there|eaux|license')
""")
def document_filter(t):
    where = (
        (F.col("n_chars") > 500) & F.col("lang").isin("en", "fr") & (F.col("source") == "src1")
        & F.col("source").isNotNull() & contains_any(F.col("text"), ["there", "eaux", "license"])
    )
    return Q.find(t("documents"), where, ["doc_id", "lang", "source", "n_chars"])


@query("sort_limit", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50
""")
def sort_limit(t):
    order = [F.desc("o_totalprice"), F.col("o_orderkey")]
    return Q.find(t("orders"), None, ["o_orderkey", "o_totalprice"], sort_by=order, limit=50)


@query("find_one", """
SELECT doc_id, lang, n_chars FROM documents WHERE lang = 'de' ORDER BY n_chars DESC, doc_id LIMIT 1
""")
def find_one(t):
    order = [F.desc("n_chars"), F.col("doc_id")]
    return Q.find_one(t("documents"), F.col("lang") == "de", order).select("doc_id", "lang", "n_chars")


@query("filtered_count", """
SELECT count(*) AS count FROM conversations WHERE role = 'user' AND text <> ''
""")
def filtered_count(t):
    return Q.count(t("conversations"), (F.col("role") == "user") & (F.col("text") != ""))


@query("thread_size_counts", f"""
WITH RECURSIVE {CONVERSATION_THREADS_SQL}
SELECT n AS larger_than, (SELECT count(*) FROM thread WHERE message_count > n) AS threads
FROM (VALUES (2), (4), (6)) s(n)
""")
def thread_size_counts(t):
    """Threads in parts, counted by their headers."""
    threads = cut(conversation_threads(t, part_chars=300), "threads")
    counts = [
        Q.count(Q.larger_than(threads, n)).select(F.lit(n).alias("larger_than"), F.col("count").alias("threads"))
        for n in (2, 4, 6)
    ]
    return counts[0].union(counts[1]).union(counts[2])


LOAD_SQL = f"""
WITH RECURSIVE {CONVERSATION_THREADS_SQL}
SELECT thread_id, md5('### CONVERSATION THREAD: ' || t.chat_name || chr(10) || '### METADATA: '
  || message_count || ' msgs | '
  || CAST(floor((end_unixtime - start_unixtime) / 60.0) AS BIGINT) || ' mins duration' || chr(10)
  || '### TRANSCRIPT: ' || chr(10) || string_agg('['
  || strftime(make_timestamp(date_unixtime * 1000000), '%Y-%m-%d %H:%M') || '] ' || said, chr(10)
  ORDER BY date_unixtime, message_id)) AS transcript_md5
FROM thread t JOIN line l ON l.chat_id = t.chat_id AND l.root_id = t.root_message_id
WHERE message_count > 3
GROUP BY thread_id, t.chat_name, message_count, end_unixtime, start_unixtime
HAVING bool_or(regexp_matches(said, '(?i)there|eaux|ción'))
"""


WORDS = ["there", "eaux", "ción"]


def _loaded(threads, **texts):
    rows = whole_transcripts(Q.load_threads(threads, F.col("message_count") > 3, **texts))
    return rows.select("thread_id", F.md5("transcript").alias("transcript_md5"))


@query("load_threads", LOAD_SQL)
def load_threads(t):
    return _loaded(conversation_threads(t), holds=contains_any(F.col("transcript"), WORDS))


@query("load_large_threads", LOAD_SQL)
def load_large_threads(t):
    """A text that stands in one part loads all parts of the thread."""
    threads = cut(conversation_threads(t, part_chars=300), "threads")
    return _loaded(threads, holds=contains_any(F.col("transcript"), WORDS))


@query("load_threads_without", LOAD_SQL.replace("HAVING bool_or(", "HAVING NOT bool_or("))
def load_threads_without(t):
    """A text that stands in one of its parts keeps a thread out."""
    threads = cut(conversation_threads(t, part_chars=300), "threads")
    return _loaded(threads, lacks=contains_any(F.col("transcript"), WORDS))


@query("stratified_sample", """
SELECT doc_id, source, n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents
  WHERE source IS NOT NULL) WHERE rn <= 5
""")
def stratified_sample(t):
    return Q.stratified_sample(
        t("documents").select("doc_id", "source", "n_chars"), "source", ["doc_id"]
    )


@query("random_sample", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY md5('7:' || o_orderkey), o_orderkey LIMIT 100
""")
def random_sample(t):
    rows = t("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return Q.random_sample(rows, ["o_orderkey"], seed="7")


@query("group_slice_unwind", """
SELECT doc_id, lang, n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rn FROM documents
  WHERE lang IS NOT NULL AND source IS NOT NULL) WHERE rn <= 3
""")
def group_slice_unwind(t):
    """The stages match, group with push, slice, unwind, replace root, project."""
    rows = Q.find(t("documents"), F.col("lang").isNotNull())
    fields = ["doc_id", "lang", "n_chars"]
    return Q.unwind(Q.group_slice(rows, "source", [F.desc("n_chars"), "doc_id"], 3, fields))


@query("layer_counts", f"""
WITH {MESSAGES_SQL}
SELECT 'users' AS layer, (SELECT count(*) FROM (SELECT DISTINCT from_id, sender FROM msg
  WHERE from_id IS NOT NULL AND sender <> '')) AS row_count
UNION ALL SELECT 'threads', (SELECT count(*) FROM orders)
UNION ALL SELECT 'messages', (SELECT count(*) FROM msg)
""")
def layer_counts(t):
    messages = event_messages(t)
    return write_all(distinct_users(messages), t("orders"), messages, fresh_path(t.spark, "layers"))


@query("layer_round_trip", """
SELECT c_custkey, c_name, c_mktsegment FROM customer
UNION ALL SELECT s_suppkey, s_name, 'SUPPLIER' FROM supplier
""")
def layer_round_trip(t):
    """Write, refuse an empty replacement, append, read."""
    base = fresh_path(t.spark, "layers")
    rows = t("customer").select("c_custkey", "c_name", "c_mktsegment")
    write_layer(rows, base, "people")
    write_layer(rows.filter("c_custkey IS NULL"), base, "people")
    added = t("supplier").select(
        F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.lit("SUPPLIER").alias("c_mktsegment"),
    )
    append_layer(added, base, "people")
    return read_layer(t.spark, base, "people")


UPSERT_SQL = """
WITH u AS (
  SELECT o_custkey AS c_custkey, o_totalprice AS c_acctbal, o_orderpriority AS last_priority FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM (SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, o_orderdate FROM orders
          UNION ALL SELECT s_suppkey, s_suppkey + 100000000, s_acctbal, 'new', TIMESTAMP '2020-01-01' FROM supplier))
  WHERE rn = 1)
SELECT coalesce(c.c_custkey, u.c_custkey) AS c_custkey, c.c_name,
  CASE WHEN u.c_custkey IS NOT NULL THEN u.c_acctbal ELSE c.c_acctbal END AS c_acctbal, u.last_priority
FROM customer c FULL JOIN u ON c.c_custkey = u.c_custkey
"""


def _balance_updates(t):
    """Each customer's latest order as an update, and suppliers as new keys."""
    orders = t("orders").select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("c_acctbal"),
        F.col("o_orderpriority").alias("last_priority"), F.col("o_orderdate").alias("at"),
    )
    new = t("supplier").select(
        F.col("s_suppkey").alias("o_orderkey"), (F.col("s_suppkey") + 100_000_000).alias("c_custkey"),
        F.col("s_acctbal").alias("c_acctbal"), F.lit("new").alias("last_priority"),
        F.lit("2020-01-01").cast("timestamp_ntz").alias("at"),
    )
    return orders.unionByName(new)


@query("upsert", UPSERT_SQL)
def upsert_query(t):
    base = t("customer").select("c_custkey", "c_name", "c_acctbal")
    merged = upsert(
        base, _balance_updates(t), ["c_custkey"], [F.desc("at"), F.desc("o_orderkey")]
    )
    return merged.select("c_custkey", "c_name", "c_acctbal", "last_priority")


@query("upsert_layer", UPSERT_SQL)
def upsert_layer_query(t):
    """The same merge on a stored layer, replacing it in place."""
    base = fresh_path(t.spark, "layers")
    write_layer(t("customer").select("c_custkey", "c_name", "c_acctbal"), base, "customer")
    upsert_layer(
        _balance_updates(t), base, "customer", ["c_custkey"], [F.desc("at"), F.desc("o_orderkey")]
    )
    return read_layer(t.spark, base, "customer").select(
        "c_custkey", "c_name", "c_acctbal", "last_priority"
    )


@query("upsert_three_keys", """
WITH u AS (
  SELECT * FROM (SELECT c_custkey FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 2)
  UNION ALL SELECT max(c_custkey) + 1 FROM customer)
SELECT coalesce(c.c_custkey, u.c_custkey) AS c_custkey, c_name,
  CASE WHEN u.c_custkey IS NOT NULL THEN 0.0 ELSE c_acctbal END AS c_acctbal
FROM customer c FULL JOIN u ON c.c_custkey = u.c_custkey
""")
def upsert_three_keys(t):
    """Three updates to a stored layer rewrite the buckets of three keys."""
    base, customers = fresh_path(t.spark, "layers"), t("customer").select("c_custkey", "c_name", "c_acctbal")
    upsert_layer(customers, base, "customer", ["c_custkey"], buckets=16)
    before = set(read_layer(t.spark, base, "customer").inputFiles())
    richest = customers.orderBy(F.desc("c_acctbal"), "c_custkey").limit(2).select("c_custkey")
    updates = richest.union(customers.agg(F.max("c_custkey") + 1)).withColumn("c_acctbal", F.lit(0.0))
    upsert_layer(updates, base, "customer", ["c_custkey"])
    now = read_layer(t.spark, base, "customer")
    if len(before - set(now.inputFiles())) > 3 * len(before) / 16:
        raise AssertionError("more than three buckets were rewritten")
    return now


@query("users_csv", f"""
WITH {MESSAGES_SQL}
SELECT DISTINCT from_id AS telegram_id, sender AS display_name FROM msg
WHERE from_id IS NOT NULL AND sender <> ''
""")
def users_csv(t):
    path = fresh_path(t.spark, "users-csv")
    export_csv(distinct_users(event_messages(t)), ["telegram_id", "display_name"], path)
    return read_users_csv(t.spark, path)
