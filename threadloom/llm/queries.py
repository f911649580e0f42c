"""The numbered queries over the test tables, and SQL for those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm.common import table
from threadloom.llm.curriculum import MixParams, demand_inverse, mix_report
from threadloom.llm.divergence import source_divergence
from threadloom.llm.fingerprints import fingerprint_documents
from threadloom.llm.html_cut import extract
from threadloom.llm.language import identify
from threadloom.llm.lexical_search import search
from threadloom.llm.minhash import NearParams, near_duplicates
from threadloom.llm.packing import PackParams, pack_documents
from threadloom.llm.quality_rules import LEAST_WORDS, LETTER, MOST_REPEATED, STOP_WORDS, TABLE, WINDOW, WORD, judge
from threadloom.llm.rotated_codes import nearest
from threadloom.llm.secret_grammar import scan
from threadloom.llm.sparse_suffix import repeated_passages
from threadloom.llm.url_templates import Rule, TreeParams, judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


RULES = [
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
]


def _rule_sql(field: str) -> str:
    cases = "".join(
        f" WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{getattr(r, field)}'"
        for r in sorted(RULES, key=lambda r: -len(r.name))
    )
    return f"CASE{cases} END"


_T = TreeParams()


def _apart_sql(some: str, of: str) -> str:
    """A segment's share differs from that of its siblings by more than chance."""
    n, rest = f"nullif({of}, 0)", f"nullif(all_{of} - {of}, 0)"
    gap = f"({some} / {n} - (all_{some} - {some}) / {rest})"
    return f"coalesce({gap} * {gap} > {_T.chance!r} * (1.0 / {n} + 1.0 / {rest}), false)"


OP9_SQL = rf"""
WITH raw AS (
  SELECT page_id, CASE WHEN url IS NULL OR instr(url, '://') = 0 THEN '' ELSE substr(url, instr(url, '://') + 3) END AS rest FROM pages
), parsed AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM raw
), ruled AS (
  SELECT *, {_rule_sql("name")} AS rule, {_rule_sql("verdict")} AS known,
    CASE WHEN path = '' THEN []::VARCHAR[] ELSE string_split(regexp_replace(path, '^/', ''), '/') END AS parts FROM parsed
), cut AS (
  SELECT * EXCLUDE parts, CASE WHEN len(parts) > {_T.depth} THEN list_append(parts[1:{_T.depth}], '**') ELSE parts END AS segments FROM ruled
), typed AS (
  SELECT *, list_transform(segments, lambda s: CASE WHEN s IN ('', '**') THEN s
      WHEN regexp_matches(s, '^[0-9]+$') THEN '{{n}}'
      WHEN regexp_matches(s, '^[0-9]+[.][a-z]{{1,5}}$') THEN '{{n}}' || regexp_extract(s, '[.][a-z]+$', 0)
      WHEN regexp_matches(s, '[0-9]') THEN '{{m}}' ELSE '{{w}}' END) AS kinds FROM cut
), numbered AS (
  SELECT row_number() OVER () AS r, * FROM typed
), exploded AS (
  SELECT r, host, known, i, segments[i] AS s, kinds[i] AS k, coalesce(array_to_string(kinds[1:i-1], '/'), '') || '>' AS node
  FROM numbered, unnest(range(1, len(segments) + 1)) AS u(i)
), counted AS (
  SELECT host, node, s, count(*) AS pages, count(known) AS n, count(*) FILTER (known = 'block') AS b,
    sum(count(*)) OVER at_node AS all_pages, sum(count(known)) OVER at_node AS all_n, sum(count(*) FILTER (known = 'block')) OVER at_node AS all_b
  FROM exploded GROUP BY host, node, s WINDOW at_node AS (PARTITION BY host, node)
), literals AS (
  SELECT host, node, s FROM counted
  WHERE NOT regexp_matches(s, '[0-9]') AND (pages * {_T.share} >= all_pages OR pages >= {_T.support}
    OR {_apart_sql("b", "n")} OR {_apart_sql("n", "pages")} OR {_apart_sql("b", "pages")})
), built AS (
  SELECT r, '/' || string_agg(coalesce(l.s, e.k), '/' ORDER BY i) AS template
  FROM exploded e LEFT JOIN literals l USING (host, node, s) GROUP BY r
), placed AS (
  SELECT n.*, CASE WHEN path = '' THEN '' ELSE template END AS template FROM numbered n LEFT JOIN built USING (r)
), leaves AS (
  SELECT host, template, count(known) AS n, count(*) FILTER (known = 'block') AS b,
    regexp_replace(template, '/[^/{{*]+((?:/(?:[{{][^/]*|[*]*))*)$', '/*\1') AS parent
  FROM placed GROUP BY host, template
), pools AS (
  SELECT host, parent, sum(n) AS pool_n, sum(b) AS pool_b FROM leaves GROUP BY host, parent
), branches AS (
  SELECT l.*, CASE WHEN n > 0 AND (b / n - pool_b / pool_n) * (b / n - pool_b / pool_n) <= {_T.chance!r} * (1.0 / n + 1.0 / pool_n)
    THEN parent ELSE template END AS branch
  FROM leaves l JOIN pools USING (host, parent)
), merged AS (
  SELECT host, branch, sum(n) AS branch_n, sum(b) AS branch_b FROM branches GROUP BY host, branch
), shared AS (
  SELECT template, (sum(b) + {_T.weight} * 0.5) / (sum(n) + {_T.weight}) AS prior FROM leaves GROUP BY template
), judged AS (
  SELECT host, template, round((branch_b + {_T.weight} * prior) / (branch_n + {_T.weight}), 6)::DOUBLE AS block_share
  FROM branches JOIN merged USING (host, branch) JOIN shared USING (template)
)
SELECT page_id, host, path, rule, coalesce(known, CASE WHEN block_share > {_T.limit} THEN 'block' ELSE 'allow' END) AS verdict,
  template, block_share
FROM placed LEFT JOIN judged USING (host, template)
"""


@query("op9_url_templates", OP9_SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"), RULES)


_M = MixParams()


def _position_sql(k: int) -> str:
    q = f"((source_size * {k} + start + words_{k + 1} / 2.0) / nullif(quota, 0))::DOUBLE"
    cases = " ".join(
        f"WHEN rank % {len(_M.schedules)} = {i} THEN {demand_inverse(s, q)}"
        for i, s in enumerate(_M.schedules)
    )
    return f"CASE WHEN words_{k + 1} > 0 THEN round(CASE {cases} END, 6) END"


OP10_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5('{_M.seed}:' || coalesce(doc_id::VARCHAR, 'null')) AS key FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM totals
), weighted AS (
  SELECT *, {list(_M.weights)!r}[rank % {len(_M.weights)} + 1]::DOUBLE AS weight, source_size * {float(_M.repeats)}::DOUBLE AS cap FROM ranked
), levels AS (
  SELECT *, cap / weight AS r, ((sum(source_size) OVER ()) * {_M.share}::DOUBLE
    - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighted
), level AS (
  SELECT level AS found FROM levels WHERE level <= r ORDER BY r, rank LIMIT 1
), targets AS (
  SELECT source, source_size, rank, coalesce(least(cap, (SELECT found FROM level) * weight), cap) AS target FROM levels
), placed AS (
  SELECT doc_id, s.source, size, source_size, rank, target, floor(target + 0.5)::BIGINT AS quota,
    (sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size)::BIGINT AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), taken AS (
  SELECT *, greatest(0, least(size, quota - start)) AS words_1, greatest(0, least(size, quota - source_size - start)) AS words_2 FROM placed
)
SELECT doc_id, source, size, source_size, round(target, 6) AS target, (words_1 + words_2)::BIGINT AS taken, words_1, words_2,
  {_position_sql(0)} AS first_position, {_position_sql(1)} AS second_position
FROM taken
"""


@query("op10_curriculum_mix", OP10_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return mix_report(table(spark, folder, "documents")).withColumn("target", F.round("target", 6))


TOKENIZER = os.path.join(os.path.dirname(find_spec("public_tokenizers").origin), "word_bpe_49k.json")


@query("op1_fingerprints")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint_documents(table(spark, folder, "documents"))


@query("op6_local_search_packing")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), PackParams(TOKENIZER))


@query("op3_string_kernels")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return identify(table(spark, folder, "documents"))


@query("op2_bbit_minhash")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), NearParams(words=4))


@query("op4_rotated_codes")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op5_secret_grammar")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return scan(table(spark, folder, "documents"))


@query("op8_sparse_suffixes")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_passages(table(spark, folder, "documents"))


@query("op7_minimum_cut")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))


OP11_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents WHERE text IS NOT NULL
), docs AS (
  SELECT r, doc_id, terms, len(terms)::BIGINT AS n FROM texts WHERE len(terms) > 0
), whole AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM docs
), postings AS (
  SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(terms) AS term FROM docs) GROUP BY r, term
), held AS (
  SELECT term, count(*)::BIGINT AS df FROM postings GROUP BY term
), items AS (
  SELECT row_number() OVER () AS i, item_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM benchmark WHERE text IS NOT NULL
), asked AS (
  SELECT i, term, count(*)::BIGINT AS times FROM (SELECT i, unnest(terms) AS term FROM items) GROUP BY i, term
), weighed AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM held, whole
), scored AS (
  SELECT i, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words))))::BIGINT AS score
  FROM asked JOIN weighed USING (term) JOIN postings USING (term) JOIN docs d USING (r), whole GROUP BY i, r
), ranked AS (
  SELECT i, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scored JOIN docs USING (r) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked JOIN items USING (i) WHERE rank <= 10
"""


@query("op11_nra_search", OP11_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def _threshold_sql(t) -> str:
    ends = [f"100 * {t.measure} < {t.low} * {t.per}"] * (t.low is not None) + [f"100 * {t.measure} > {t.high} * {t.per}"] * (t.high is not None)
    return f"CASE WHEN {' OR '.join(ends)} THEN '{t.name}' END"


_STOP = ", ".join(f"'{w}'" for w in sorted({w for group in STOP_WORDS.values() for w in group}))
OP12_SQL = rf"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body,
    regexp_extract_all(coalesce(text, ''), '{WORD}') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
  FROM documents
), grams AS (
  SELECT r, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS gram FROM split, unnest(range(1, len(words) - {WINDOW - 2})) AS u(i)
), twice AS (
  SELECT r, i FROM grams QUALIFY count(*) OVER (PARTITION BY r, gram) > 1
), covered AS (
  SELECT r, count(DISTINCT i + j) AS n FROM twice, range({WINDOW}) AS v(j) GROUP BY r
), counted AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
    length(regexp_replace(body, '[ 	-
]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    length(regexp_replace(body, '[^!]+', '', 'g'))::BIGINT AS n_exclamations,
    len(list_filter(words, lambda w: regexp_matches(w, '{LETTER}')))::BIGINT AS n_letter_words,
    len(list_filter(regexp_extract_all(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{LETTER}+'),
      lambda t: t IN ({_STOP})))::BIGINT AS n_stop_words,
    len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '^[ 	-
]*[-*•]')))::BIGINT AS n_bullet_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[ 	-
]*$')))::BIGINT AS n_ellipsis_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN covered USING (r)
), ruled AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
    concat_ws(',', {", ".join(_threshold_sql(t) for t in TABLE)}) AS broken_rules
  FROM counted
)
SELECT *, NOT base_failed AND broken_rules = '' AS kept FROM ruled
"""


@query("op12_threshold_table", OP12_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "documents"))


OP13_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), found AS (
  SELECT r, lang, source, unnest(terms) AS term FROM texts
), kept AS (
  SELECT lang, term, count(*)::BIGINT AS n FROM found GROUP BY lang, term HAVING count(DISTINCT r) >= 10
), counts AS (
  SELECT lang, source, term, count(*)::BIGINT AS n FROM found GROUP BY lang, source, term
), groups AS (
  SELECT DISTINCT lang, source FROM texts
), cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, k.n::HUGEINT AS lang_n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), totals AS (
  SELECT lang, source, sum(n)::HUGEINT AS total, count(*)::HUGEINT AS v, sum(lang_n)::HUGEINT AS lang_total FROM cells GROUP BY lang, source
), shares AS (
  SELECT lang, source, term, n, (1 + (1000000000 * (n + 2)) // (total + 2 * v))::BIGINT AS p,
    (1 + (1000000000 * (lang_n + 2)) // (lang_total + 2 * v))::BIGINT AS q
  FROM cells JOIN totals USING (lang, source)
), pairs AS (
  SELECT g.lang, g.source, h.source AS item FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p))::BIGINT AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), parts AS (
  SELECT p.lang, p.source, 'pair' AS part, p.item, coalesce(s.value, 0)::BIGINT AS value
  FROM pairs p LEFT JOIN sums s ON p.lang = s.lang AND p.source = s.source AND p.item = s.item
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@query("op13_dominance_skyband", OP13_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence(table(spark, folder, "documents"))
