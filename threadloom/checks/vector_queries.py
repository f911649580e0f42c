"""Embeddings: scores, exact and pruned top-k, storing."""

from pyspark.sql import functions as F

from threadloom.checks.registry import query
from threadloom.checks.views import document_summaries
from threadloom.lineage import cut, fresh_path
from threadloom.operators import vectors as V
from threadloom.sources.layers import read_layer, write_layer

CENTROIDS_SQL = """
comp AS (SELECT label, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding) AS v FROM embeddings)
, cen AS (SELECT label, list(m ORDER BY i) AS q FROM (
    SELECT label, i, avg(CAST(v AS DOUBLE)) AS m FROM comp GROUP BY ALL) GROUP BY label)
, sim AS (
  SELECT c.label AS query_id, e.vec_id, e.label,
    list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), c.q) AS score
  FROM embeddings e, cen c)
"""


def centroids(t):
    """Mean vector of every label, as queries."""
    parts = t("embeddings").select("label", F.posexplode("embedding").alias("i", "v"))
    means = parts.groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("m"))
    return means.groupBy("label").agg(
        F.sort_array(F.collect_list(F.struct("i", "m"))).alias("_m")
    ).select(
        F.col("label").cast("bigint").alias("query_id"),
        F.transform("_m", lambda x: x["m"]).alias("embedding"),
    )


def _shown(top):
    return top.select(
        "query_id", "vec_id", F.col("rank").cast("bigint").alias("rank"),
        F.round("score", 4).alias("score"),
    )


@query("cosine_scores", """
WITH s AS (SELECT a.vec_id, a.label, a.embedding, b.embedding AS other
  FROM embeddings a JOIN embeddings b ON b.vec_id = (a.vec_id + 1) % (SELECT count(*) FROM embeddings))
SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(other AS DOUBLE[])), 4) AS score
FROM s
""")
def cosine_scores(t):
    """Each vector against the next one."""
    e = t("embeddings")
    nxt = e.withColumn("next_id", (F.col("vec_id") + 1) % F.lit(e.count()))
    other = e.select(F.col("vec_id").alias("next_id"), F.col("embedding").alias("other"))
    pairs = nxt.join(other, "next_id")
    return pairs.select("vec_id", F.round(V.cosine(F.col("embedding"), F.col("other")), 4).alias("score"))


@query("vector_topk", f"""
WITH {CENTROIDS_SQL}
SELECT query_id, vec_id, rank, round(score, 4) AS score FROM (
  SELECT CAST(query_id AS BIGINT) AS query_id, vec_id, score,
    row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM sim)
WHERE rank <= 10
""")
def vector_topk(t):
    return _shown(V.vector_topk(t("embeddings"), centroids(t), 10, "vec_id", domain=None))


@query("vector_topk_filtered", f"""
WITH {CENTROIDS_SQL}
SELECT query_id, vec_id, rank, label, round(score, 4) AS score FROM (
  SELECT CAST(query_id AS BIGINT) AS query_id, vec_id, label, score,
    row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM sim WHERE label = query_id)
WHERE rank <= 3
""")
def vector_topk_filtered(t):
    """Each centroid searches only vectors of its own label."""
    queries = centroids(t).withColumn("l1_domain", F.col("query_id").cast("string"))
    corpus = t("embeddings").withColumn("domain", F.col("label").cast("string"))
    top = V.vector_topk(corpus, queries, 3, "vec_id", domain="domain", keep=["label"])
    return top.select(
        "query_id", "vec_id", F.col("rank").cast("bigint").alias("rank"), "label",
        F.round("score", 4).alias("score"),
    )


LEADERS = 32


PRUNED_SQL = f"""
{CENTROIDS_SQL}
, lead AS (SELECT row_number() OVER (ORDER BY d, vec_id) - 1 AS leader_id, embedding FROM (
    SELECT md5('0:' || vec_id) AS d, vec_id, embedding FROM embeddings ORDER BY d, vec_id LIMIT {LEADERS}))
, near AS (SELECT vec_id, leader_id FROM (
    SELECT e.vec_id, l.leader_id, row_number() OVER (PARTITION BY e.vec_id ORDER BY
      list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(l.embedding AS DOUBLE[])) DESC, leader_id) AS rn
    FROM embeddings e, lead l) WHERE rn = 1)
, size AS (SELECT leader_id, count(*) AS n FROM near GROUP BY ALL)
, probe AS (SELECT query_id, leader_id FROM (
    SELECT c.label AS query_id, l.leader_id, coalesce(sum(s.n) OVER (PARTITION BY c.label
      ORDER BY list_cosine_similarity(CAST(l.embedding AS DOUBLE[]), c.q) DESC, l.leader_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held
    FROM cen c, lead l LEFT JOIN size s ON s.leader_id = l.leader_id) WHERE held < 100)
, pruned AS (SELECT * FROM (
  SELECT CAST(query_id AS BIGINT) AS query_id, vec_id, score,
    row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM sim JOIN near USING (vec_id) JOIN probe USING (query_id, leader_id))
WHERE rank <= 10)
"""


@query("vector_topk_pruned", f"WITH {PRUNED_SQL} SELECT query_id, vec_id, rank, round(score, 4) AS score FROM pruned")
def vector_topk_pruned(t):
    return _shown(_pruned(t))


def _pruned(t):
    e = t("embeddings").select("vec_id", "embedding")
    leaders = V.pick_leaders(e, LEADERS, "vec_id")
    base = fresh_path(t.spark, "clusters")
    write_layer(V.follow_leaders(e, leaders), base, "corpus", partition_by=["leader_id"])
    clustered = read_layer(t.spark, base, "corpus")
    return V.vector_topk_pruned(clustered, leaders, centroids(t), 10, id_col="vec_id", domain=None)


@query("vector_recall", f"""
WITH {PRUNED_SQL}
, exact AS (SELECT query_id, vec_id FROM (
    SELECT query_id, vec_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM sim) WHERE rank <= 10)
SELECT CAST(e.query_id AS BIGINT) AS query_id, count(*) AS wanted, count(p.vec_id) AS found
FROM exact e LEFT JOIN pruned p ON p.query_id = e.query_id AND p.vec_id = e.vec_id GROUP BY e.query_id
""")
def vector_recall(t):
    """Exact results that the pruned search finds, per query."""
    return V.recall(_pruned(t), V.vector_topk(t("embeddings"), centroids(t), 10, "vec_id", domain=None), "vec_id")


@query("vector_topk_cells", f"""
WITH {CENTROIDS_SQL}
SELECT query_id, vec_id, rank, round(score, 4) AS score FROM (
  SELECT CAST(query_id AS BIGINT) AS query_id, vec_id, score,
    row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM sim)
WHERE rank <= 10
""")
def vector_topk_cells(t):
    """All clusters probed: inverted lists that hold everything give the exact result."""
    e = t("embeddings").select("vec_id", "embedding")
    leaders = V.pick_leaders(e, LEADERS, "vec_id")
    everything = e.count()
    return _shown(V.vector_topk_pruned(
        cut(V.follow_leaders(e, leaders), "clusters"), leaders, centroids(t), 10, candidates=everything, id_col="vec_id", domain=None
    ))


@query("embed_and_store", """
SELECT 'doc ' || doc_id AS thread_id, i, round(CAST(CAST((length(text) - length(replace(text, c, ''))) / CAST(length(text) AS DOUBLE) AS FLOAT) AS DOUBLE), 4) AS v
FROM documents, (VALUES (0, 'a'), (1, 'e'), (2, 'o'), (3, ' ')) s(i, c)
""")
def embed_and_store(t):
    """Letter shares as the embedding; stored twice by key, read back as entries."""
    def shares(row):
        text = row["summary"]
        return [text.count(c) / len(text) for c in "aeo "]

    documents = document_summaries(t).withColumn("l1_domain", F.lit("ROOT A"))
    base = fresh_path(t.spark, "vectors")
    V.embed_and_store(documents, base, "summaries", shares)
    V.embed_and_store(documents, base, "summaries", shares)
    return read_layer(t.spark, base, "summaries").select(
        "thread_id", F.posexplode("embedding").alias("i", "v")
    ).select("thread_id", "i", F.round(F.col("v").cast("double"), 4).alias("v"))


@query("hashed_embedding", r"""
WITH w AS (
  SELECT doc_id, md5(unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'))) AS m
  FROM documents)
, e AS (
  SELECT doc_id, CAST(CAST('0x' || substr(m, 1, 8) AS UBIGINT) % 1024 AS INTEGER) AS i,
    sum(CASE WHEN substr(m, 9, 1) < '8' THEN 1 ELSE -1 END) AS v FROM w GROUP BY ALL)
SELECT 'doc ' || doc_id AS thread_id, i, round(CAST(CAST(v / sqrt(sum(v * v) OVER (PARTITION BY doc_id)) AS FLOAT) AS DOUBLE), 5) AS v
FROM e QUALIFY v <> 0
""")
def hashed_embedding(t):
    """The entries of the default embedding that are not zero."""
    vectors, _ = V.embed(document_summaries(t).withColumn("l1_domain", F.lit("ROOT A")))
    entries = vectors.select("thread_id", F.posexplode("embedding").alias("i", "v")).filter("v <> 0")
    return entries.select("thread_id", "i", F.round(F.col("v").cast("double"), 5).alias("v"))
