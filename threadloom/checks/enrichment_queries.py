"""Model jobs, routing, taxonomy, triplets and the knowledge graph."""

import hashlib

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from threadloom.checks.registry import query
from threadloom.checks.thread_queries import CONVERSATION_THREADS_SQL, conversation_threads
from threadloom.checks.views import (
    LEXICON,
    ROUTED_SQL,
    TRIPLETS_SQL,
    document_summaries,
    line_triplets,
)
from threadloom.functions.text import extract_tag
from threadloom.lineage import cut, fresh_path
from threadloom.operators import graph as G
from threadloom.operators import routing, taxonomy, triplets
from threadloom.operators.models import map_model, map_model_logged
from threadloom.operators.speakers import tag_speakers
from threadloom.plans.enrichment import run_enrichment
from threadloom.sources.layers import layer_version, read_layer


@query("extract_tag", r"""
WITH c AS (SELECT page_id, trim(replace(replace(html, '```xml', ''), '```', ''),
    ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS clean FROM pages)
SELECT page_id, md5(CASE WHEN regexp_matches(clean, '(?s)<title>(.*?)</title>')
    THEN trim(regexp_extract(clean, '(?s)<title>(.*?)</title>', 1), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))
  WHEN length(clean) > 50 THEN clean ELSE '' END) AS title_md5
FROM c
""")
def extract_tag_query(t):
    return t("pages").select("page_id", F.md5(extract_tag(F.col("html"), "title")).alias("title_md5"))


@query("map_model", """
SELECT doc_id, CASE WHEN error IS NULL THEN CAST(length(text) AS BIGINT) END AS chars,
  CASE WHEN error IS NULL THEN md5(text) END AS digest, error
FROM (SELECT *, CASE WHEN doc_id % 7 = 0 THEN 'ValueError' WHEN doc_id % 11 = 3 THEN 'NoAnswer'
  WHEN doc_id % 13 = 5 THEN 'ArrowInvalid' END AS error FROM documents)
""")
def map_model_query(t):
    """Texts of any length; some ids raise, give no answer, or answer with a wrong type."""
    def describe(row):
        if row["doc_id"] % 7 == 0:
            raise ValueError("refused")
        if row["doc_id"] % 11 == 3:
            return None
        chars = "many" if row["doc_id"] % 13 == 5 else len(row["text"])
        return {"chars": chars, "digest": hashlib.md5(row["text"].encode()).hexdigest()}

    results = map_model(
        t("documents").select("doc_id", "text"), describe, ["doc_id"],
        "struct<chars:bigint,digest:string>",
    )
    kind = F.substring_index("error", ":", 1)
    return results.select("doc_id", "result.chars", "result.digest", kind.alias("error"))


def routed_documents(t):
    return routing.route_by_lexicon(document_summaries(t), LEXICON)


def anchored_documents(t):
    """Routed once and stored, as the enrichment does."""
    return cut(routed_documents(t), "anchored")


@query("map_model_logged", """
SELECT doc_id, CASE WHEN doc_id % 7 <> 0 THEN CAST(length(text) AS BIGINT) END AS chars,
  CASE WHEN doc_id % 7 = 0 THEN 'ValueError' END AS error, 1 AS calls
FROM documents
""")
def map_model_logged_query(t):
    """A run that dies on the way and one that goes on: every row is called once.

    An answer carries the number of the run; rows that the first run answered keep it.
    """
    documents = t("documents").select("doc_id", "text")
    base = fresh_path(t.spark, "calls")

    def describe(run, stop):
        def call(row):
            if stop and row["doc_id"] == stop:
                raise KeyboardInterrupt  # ends the task, unlike an error of the row
            if row["doc_id"] % 7 == 0:
                raise ValueError("refused")
            return {"chars": len(row["text"]), "run": run}

        return call

    last = documents.agg(F.max("doc_id")).first()[0]
    kind = "struct<chars:bigint,run:int>"
    try:
        map_model_logged(documents, describe(1, last), ["doc_id"], kind, base, "calls", batches=4)
        raise AssertionError("the first run should die")
    except PySparkException:
        pass
    before = None
    if layer_version(t.spark, base, "calls") is not None:
        before = cut(read_layer(t.spark, base, "calls"), "first-answers")
    out = cut(map_model_logged(documents, describe(2, None), ["doc_id"], kind, base, "calls", batches=4), "answers")
    if before is not None and before.join(out, "doc_id").filter(before["result.run"] != out["result.run"]).count():
        raise AssertionError("a row was called again")
    counts = read_layer(t.spark, base, "calls").groupBy("doc_id").agg(F.count("*").cast("int").alias("calls"))
    return out.join(counts, "doc_id").select("doc_id", "result.chars", F.substring_index("error", ":", 1).alias("error"), "calls")


@query("route_by_lexicon", f"WITH {ROUTED_SQL} SELECT thread_id, root FROM routed")
def route_by_lexicon(t):
    return routed_documents(t).select("thread_id", "root")


@query("route_by_model", """
SELECT 'doc ' || doc_id AS thread_id, CASE lang WHEN 'en' THEN 'ROOT A' WHEN 'fr' THEN 'ROOT B'
  ELSE 'ROOT X' END AS root FROM documents
""")
def route_by_model(t):
    """English is tagged, French in a code fence, German unknown, Spanish fails."""
    def answer(row):
        return {
            "en": "<classification> ROOT A\n</classification>",
            "fr": "```xml\n<classification>ROOT B</classification>\n```",
            "de": "<classification>ROOT Q</classification>",
        }[row["summary"]]

    rows = t("documents").select(
        F.concat(F.lit("doc "), "doc_id").alias("thread_id"), F.col("lang").alias("summary")
    )
    return routing.route_by_model(rows, answer).select("thread_id", "root")


BATCH_SQL = f"""
{ROUTED_SQL}
, sized AS (
  SELECT root, CAST(ceil(count(*) / 200.0) AS BIGINT) AS batch_count FROM routed GROUP BY root)
, batched AS (
  SELECT root AS root_id, CAST('0x' || substr(md5(thread_id), 1, 8) AS BIGINT) % batch_count AS batch_no,
    thread_id, summary, lang, source
  FROM routed JOIN sized USING (root))
"""


@query("summaries_by_root", f"""
WITH {BATCH_SQL}
SELECT root_id, batch_no, count(*) AS summaries,
  md5(string_agg(summary, chr(10) ORDER BY thread_id)) AS text_md5
FROM batched GROUP BY ALL
""")
def summaries_by_root(t):
    return routing.group_by_root(anchored_documents(t), batch=200).select(
        "root_id", "batch_no", F.size("summaries").cast("bigint").alias("summaries"),
        F.md5(F.array_join("summaries", "\n")).alias("text_md5"),
    )


TREES_SQL = """
cur AS (SELECT DISTINCT p_brand AS root_id, p_type AS domain, p_name AS topic FROM part)
, upd AS (SELECT DISTINCT p_brand AS root_id, 'Size ' || p_size AS domain, p_name AS topic FROM part
          WHERE p_type = 'SMALL')
"""


def _trees(t):
    part = t("part")
    current = part.select(
        F.col("p_brand").alias("root_id"), F.col("p_type").alias("domain"), F.col("p_name").alias("topic")
    ).distinct()
    updated = part.filter(F.col("p_type") == "SMALL").select(
        F.col("p_brand").alias("root_id"), F.concat(F.lit("Size "), "p_size").alias("domain"),
        F.col("p_name").alias("topic"),
    ).distinct()
    return current, updated


@query("merge_taxonomy", f"""
WITH {TREES_SQL}
SELECT * FROM cur WHERE root_id NOT IN (SELECT root_id FROM upd) UNION ALL SELECT * FROM upd
""")
def merge_taxonomy(t):
    return taxonomy.merge_taxonomy(*_trees(t))


@query("current_tree", f"""
WITH {TREES_SQL}
, d AS (SELECT root_id, domain, string_agg(topic, ',' ORDER BY topic) AS topics FROM upd GROUP BY ALL)
SELECT b.root_id, coalesce((SELECT string_agg(domain || ':' || topics, ';' ORDER BY domain)
  FROM d WHERE d.root_id = b.root_id), '') AS tree
FROM (SELECT DISTINCT p_brand AS root_id FROM part UNION ALL SELECT 'No brand') b
""")
def current_tree(t):
    _, tree = _trees(t)
    none = t.spark.createDataFrame([("No brand",)], "root_id string")
    roots = t("part").select(F.col("p_brand").alias("root_id")).distinct().unionByName(none)
    domain = F.transform(
        "current_tree",
        lambda d: F.concat(d["domain"], F.lit(":"), F.array_join(d["topics"], ",")),
    )
    return taxonomy.with_current_tree(roots, tree).select(
        "root_id", F.array_join(domain, ";").alias("tree")
    )


@query("induce_taxonomy", f"""
WITH {ROUTED_SQL}
SELECT DISTINCT root AS root_id, lang AS domain, source AS topic FROM routed WHERE root <> 'ROOT X'
UNION ALL SELECT 'ROOT X', 'kept', 'as it was'
""")
def induce_taxonomy(t):
    """Languages become domains, sources topics; ROOT X fails and keeps its tree."""
    def induce(row):
        if row["root_id"] == "ROOT X":
            raise RuntimeError("no answer")
        domains = {}
        for summary in row["summaries"]:
            lang, source = summary.split("|")
            domains.setdefault(lang, set()).add(source)
        stale = [{"domain": lang, "topics": ["overwritten"]} for lang in domains]
        return stale + [{"domain": d, "topics": sorted(s)} for d, s in domains.items()]

    anchored = routing.route_by_lexicon(
        t("documents").select(
            F.concat(F.lit("doc "), "doc_id").alias("thread_id"),
            F.col("text").alias("summary"), F.concat_ws("|", "lang", "source").alias("short"),
        ),
        LEXICON,
    ).select("thread_id", F.col("short").alias("summary"), "root")
    before = t.spark.createDataFrame(
        [("ROOT A", "kept", "as it was"), ("ROOT X", "kept", "as it was")],
        "root_id string, domain string, topic string",
    )
    def combine(row):
        topics = {}
        for answer in row["partials"]:
            for name, found in {d["domain"]: d["topics"] for d in answer}.items():
                topics.setdefault(name, set()).update(found)
        return [{"domain": d, "topics": sorted(s)} for d, s in topics.items()]

    tree, _ = taxonomy.induce_taxonomy(anchored, before, induce, batch=200, combine=combine)
    return tree


@query("taxonomy_partial_failure", f"""
WITH {ROUTED_SQL}
, sized AS (
  SELECT root, CAST(ceil(count(*) / 20.0) AS BIGINT) AS batch_count FROM routed GROUP BY root)
SELECT root AS root_id, 'size' AS domain, CAST(batch_count AS VARCHAR) AS topic FROM sized WHERE batch_count = 1
UNION ALL SELECT root, 'kept', 'as it was' FROM sized WHERE batch_count > 1
""")
def taxonomy_partial_failure(t):
    """One failing batch of several: the root keeps its tree."""
    def induce(row):
        if row["batch_no"] == 1:
            raise RuntimeError("no answer")
        return [{"domain": "size", "topics": ["1"]}]

    anchored = anchored_documents(t)
    before = anchored.select(F.col("root").alias("root_id")).distinct().select(
        "root_id", F.lit("kept").alias("domain"), F.lit("as it was").alias("topic")
    )
    tree, _ = taxonomy.induce_taxonomy(anchored, before, induce, batch=20)
    return tree


@query("taxonomy_tree", f"""
WITH {ROUTED_SQL}
, sized AS (SELECT root, CAST(ceil(count(*) / 5.0) AS BIGINT) AS batch_count FROM routed GROUP BY root)
SELECT DISTINCT root AS root_id, lang AS domain, source AS topic FROM routed JOIN sized USING (root)
WHERE root <> 'ROOT B' OR batch_count <= 4
UNION ALL SELECT root, 'kept', 'as it was' FROM sized WHERE root <> 'ROOT B' OR batch_count > 4
""")
def taxonomy_tree(t):
    """Batches of five, four answers a call: languages with their sources. Every inner call of ROOT B fails.

    The tree that a root had is added by its last call, and by that one alone.
    """
    def induce(row):
        pairs = [x.split("|") for x in row["summaries"]]
        return [{"domain": d, "topics": sorted({s for lang, s in pairs if lang == d})} for d in {lang for lang, _ in pairs}]

    def combine(row):
        if row["root_id"] == "ROOT B" and not row["is_last"]:
            raise RuntimeError("no answer")
        if len(row["partials"]) > 4 or (row["current_tree"] and not row["is_last"]):
            raise AssertionError("too many answers, or the tree came early")
        topics = {d["domain"]: set(d["topics"]) for d in row["current_tree"] if row["root_id"] != "ROOT B"}
        for answer in row["partials"]:
            for d in answer:
                topics.setdefault(d["domain"], set()).update(d["topics"])
        return [{"domain": d, "topics": sorted(s)} for d, s in topics.items()]

    anchored = routing.route_by_lexicon(
        t("documents").select(
            F.concat(F.lit("doc "), "doc_id").alias("thread_id"),
            F.col("text").alias("summary"), F.concat_ws("|", "lang", "source").alias("short"),
        ),
        LEXICON,
    ).select("thread_id", F.col("short").alias("summary"), "root")
    before = anchored.select(F.col("root").alias("root_id")).distinct().select(
        "root_id", F.lit("kept").alias("domain"), F.lit("as it was").alias("topic")
    )
    tree, _ = taxonomy.induce_taxonomy(anchored, before, induce, batch=5, combine=combine, fan_in=4)
    return tree


@query("speaker_roles", """
SELECT conv_id, turn, CASE role WHEN 'assistant' THEN 'Answer Expert,Moderator'
  WHEN 'system' THEN 'Moderator' ELSE 'Participant' END AS roles
FROM conversations
""")
def speaker_roles(t):
    """An ontology derived from the roles present in the table."""
    speakers = t("conversations").select(F.col("role").alias("speaker")).distinct()
    ontology = speakers.filter("speaker = 'assistant'").withColumn("role", F.lit("Answer Expert")).union(
        speakers.filter("speaker IN ('assistant', 'system')").withColumn("role", F.lit("Moderator"))
    )
    tagged = tag_speakers(t("conversations").withColumnRenamed("role", "sender"), ontology)
    return tagged.select("conv_id", "turn", F.array_join("roles", ",").alias("roles"))


@query("graph_edges", f"WITH {TRIPLETS_SQL} SELECT * FROM edge")
def graph_edges(t):
    return G.edges(line_triplets(t))


@query("graph_entities", f"""
WITH {TRIPLETS_SQL} SELECT subject AS name FROM edge UNION SELECT object FROM edge
""")
def graph_entities(t):
    return G.build_graph(line_triplets(t))[0]


@query("triplets_by_threads", f"""
WITH {TRIPLETS_SQL}
SELECT subject, lower(predicate) AS predicate, object, context, thread_id FROM edge
WHERE thread_id IN (SELECT 'order ' || o_orderkey FROM orders WHERE o_orderstatus = 'F')
""")
def triplets_by_threads(t):
    wanted = t("orders").filter(F.col("o_orderstatus") == "F").select(
        F.concat(F.lit("order "), "o_orderkey")
    )
    return G.triplets_by_threads(G.edges(line_triplets(t)), wanted)


@query("merge_edges", f"""
WITH {TRIPLETS_SQL}
, stored AS (SELECT 'Supplier#000000000' AS subject, predicate, object, 'old' AS thread_id, 'old' AS topic,
    'old' AS context FROM (SELECT DISTINCT predicate, object FROM edge))
SELECT * FROM edge UNION ALL SELECT * FROM stored s WHERE NOT EXISTS (
  SELECT 1 FROM edge e WHERE e.subject = s.subject AND e.predicate = s.predicate AND e.object = s.object)
""")
def merge_edges(t):
    new = line_triplets(t)
    old = F.lit("old")
    stored = G.edges(new).select("predicate", "object").distinct().select(
        F.lit("Supplier#000000000").alias("subject"), "predicate", "object",
        old.alias("thread_id"), old.alias("topic"), old.alias("context"),
    )
    return G.merge_edges(stored, new)


PACKETS_SQL = """
line AS (
  SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity, s_name, p_type, p_name
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)
"""


def line_packets(t):
    """One JSON packet per line item: a relation line and a line of another form."""
    wide = (
        t("lineitem")
        .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    relation = F.concat(
        F.lit("["), "s_name", F.lit("] -> ( ships "), F.lower("p_type"), F.lit(") -> [ "), "p_name",
        F.lit("]: quantity "), F.col("l_quantity").cast("int"),
    )
    packet = F.struct(
        F.col("p_name").alias("overarching_theme"),
        F.array(relation, F.lit("no relation here")).alias("cross_domain_relationships"),
    )
    return wide.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey").alias("thread_id"),
        F.to_json(packet).alias("summary"),
        F.when(F.col("l_linenumber") > 1, F.lit("ROOT C")).alias("root"),
    )


@query("parse_relationships", f"""
WITH {PACKETS_SQL}
SELECT l_orderkey || '-' || l_linenumber || '-' || l_suppkey || '-' || l_partkey AS thread_id,
  CASE WHEN l_linenumber > 1 THEN 'ROOT C' ELSE 'General_Discourse' END AS topic,
  s_name AS subject, 'ships ' || lower(p_type) AS predicate, p_name AS object,
  'quantity ' || CAST(l_quantity AS INTEGER) AS context
FROM line
""")
def parse_relationships(t):
    return triplets.parse_relationships(line_packets(t)).drop("pos")


@query("extract_triplets", """
SELECT 'order ' || o_orderkey AS thread_id, 'General_Discourse' AS topic,
  'Customer ' || o_custkey AS subject, 'placed' AS predicate, 'Order ' || o_orderkey AS object,
  o_orderpriority AS context, NULL AS error
FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT 'order ' || o_orderkey, NULL, NULL, NULL, NULL, NULL, 'ValueError: pending'
FROM orders WHERE o_orderstatus = 'P'
""")
def extract_triplets(t):
    """Orders as summaries; pending ones fail and are kept with their error."""
    def extract(row):
        order, customer, status, priority = row["summary"].split("|")
        if status == "P":
            raise ValueError("pending")
        return [{
            "subject": f"Customer {customer}", "predicate": "placed", "object": f"Order {order}",
            "context": priority,
        }]

    orders = t("orders").select(
        F.concat(F.lit("order "), "o_orderkey").alias("thread_id"),
        F.concat_ws("|", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").alias("summary"),
    )
    rows, lost = triplets.extract_triplets(orders, extract)
    return rows.drop("pos").unionByName(lost, allowMissingColumns=True)


def _enriched(t, part_chars=None):
    """Conversation threads summarised into packets that name their own relation."""
    import json

    def summarise(row):
        lines = row["transcript"].split("\n")
        messages = len(lines)
        if "] system: " in row["transcript"]:
            raise ValueError("system prompt")
        name = lines[0].removeprefix("### CONVERSATION THREAD: ")
        return json.dumps({
            "overarching_theme": lines[1],
            "cross_domain_relationships": [f"[{name}] -> (has lines) -> [Lines]: {messages}"],
        })

    def part(row):
        if "] system: " in row["transcript"]:
            raise ValueError("system prompt")
        return row["transcript"]

    def combine(row):
        return summarise({"transcript": "\n".join(row["parts"])})

    where, lexicon = F.col("message_count") > 2, [("ROOT B", "msgs")]
    if part_chars:
        return run_enrichment(conversation_threads(t, part_chars), part, where, lexicon=lexicon, combine=combine)
    return run_enrichment(conversation_threads(t), summarise, where, lexicon=lexicon)


ENRICHED_SQL = CONVERSATION_THREADS_SQL + """
, work AS (
  SELECT thread_id, t.chat_name, bool_or(sender = 'system') AS has_system,
    sum(length(text) - length(replace(text, chr(10), '')) + 1) + 3 AS n_lines
  FROM thread t JOIN attached a ON a.chat_id = t.chat_id AND a.root_id = t.root_message_id
  WHERE message_count > 2 GROUP BY ALL)
"""


@query("enrichment_edges", f"""
WITH RECURSIVE {ENRICHED_SQL}
SELECT chat_name AS subject, 'HAS_LINES' AS predicate, 'Lines' AS object, thread_id, 'ROOT B' AS topic,
  CAST(CAST(n_lines AS BIGINT) AS VARCHAR) AS context
FROM work WHERE NOT has_system
""")
def enrichment_edges(t):
    return _enriched(t)["edges"]


@query("enrichment_in_parts", f"""
WITH RECURSIVE {ENRICHED_SQL}
SELECT chat_name AS subject, 'HAS_LINES' AS predicate, 'Lines' AS object, thread_id, 'ROOT B' AS topic,
  CAST(CAST(n_lines AS BIGINT) AS VARCHAR) AS context
FROM work WHERE NOT has_system
""")
def enrichment_in_parts(t):
    """Threads cut into small parts give the same edges: one summary and root per thread."""
    return _enriched(t, part_chars=300)["edges"]


@query("enrichment_failed", f"""
WITH RECURSIVE {ENRICHED_SQL}
SELECT thread_id, 'summary' AS phase, 'ValueError: system prompt' AS error FROM work WHERE has_system
""")
def enrichment_failed(t):
    return _enriched(t)["failed"]
