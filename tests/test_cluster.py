"""Queries that keep intermediate tables, on a cluster whose checkpoint folder names no file system."""

import duckdb
import pytest
from compare import differences
from test_lineage import on_cluster  # noqa: F401

import __spark_entry__ as entry

ROWS = {
    "events": """
        SELECT i AS event_id, TIMESTAMP '2024-01-01' + to_seconds(i * 613) AS ts, i % 17 AS user_id,
          ['click', 'signup', 'view', 'error'][1 + i % 4] AS event_type, (i * 37 % 500) + 0.25 AS value,
          '{"k": ' || i % 9 || '}' AS props
        FROM range(400) r(i)""",
    "documents": """
        SELECT i AS doc_id, text, ['en', 'fr', 'de', 'es'][1 + i % 4] AS lang, ['web', 'books'][1 + i % 2] AS source,
          length(text) AS n_chars
        FROM (SELECT i, repeat(['the station is over there. ', 'des eaux et oui. ', 'und schen eiten. ', 'para la nación. '][1 + i % 4],
          1 + CAST(i % 3 AS INTEGER)) || i AS text FROM range(60) r(i))""",
    "conversations": """
        SELECT c AS conv_id, u AS turn, CASE WHEN u = 0 AND c % 4 = 3 THEN 'system' WHEN u % 2 = 0 THEN 'user' ELSE 'assistant' END AS role,
          CASE WHEN c % 3 = 0 THEN 'over there' ELSE 'nothing' END || repeat(' and words', 20) || ' ' || c || ' ' || u AS text
        FROM range(12) a(c), range(6) b(u) WHERE u < 2 + c % 5""",
    "customer": """
        SELECT i AS c_custkey, 'Customer ' || i AS c_name, CAST(i % 5 AS INTEGER) AS c_nationkey, i * 1.5::DOUBLE AS c_acctbal,
          ['BUILDING', 'MACHINERY'][1 + i % 2] AS c_mktsegment
        FROM range(40) r(i)""",
    "supplier": """
        SELECT i AS s_suppkey, 'Supplier ' || i AS s_name, CAST(i % 5 AS INTEGER) AS s_nationkey, i * 2.5::DOUBLE AS s_acctbal
        FROM range(10) r(i)""",
    "part": """
        SELECT i AS p_partkey, 'part ' || i AS p_name, 'Brand#' || i % 5 AS p_brand, ['ECONOMY', 'SMALL'][1 + i % 2] AS p_type,
          CAST(1 + i % 7 AS INTEGER) AS p_size, i * 1.25::DOUBLE AS p_retailprice
        FROM range(40) r(i)""",
    "orders": """
        SELECT i AS o_orderkey, i % 40 AS o_custkey, ['F', 'O', 'P'][1 + i % 3] AS o_orderstatus, i * 10.5::DOUBLE AS o_totalprice,
          TIMESTAMP '2023-05-01' + to_days(CAST(i AS INTEGER)) AS o_orderdate, ['1-URGENT', '5-LOW'][1 + i % 2] AS o_orderpriority
        FROM range(60) r(i)""",
}

QUERIES = [
    "current_tree", "dropped_threads", "embed_and_store", "enrichment_edges", "enrichment_failed",
    "enrichment_in_parts", "etl_report", "etl_threads", "extract_triplets", "gold_threads_in_parts", "induce_taxonomy",
    "layer_counts", "layer_round_trip", "load_threads", "load_large_threads", "load_threads_without", "map_model",
    "map_model_logged", "message_payload", "nested_participants", "participants", "reaction_counts",
]


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """A folder of small tables, and a DuckDB connection over them."""
    folder, con = tmp_path_factory.mktemp("tables"), duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name, sql in ROWS.items():
        con.execute(f"COPY ({sql}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return str(folder), con


@pytest.mark.parametrize("name", QUERIES)
def test_query_on_a_cluster(spark, on_cluster, tables, name):  # noqa: F811
    folder, con = tables
    assert differences(entry.queries()[name](spark, folder), con, entry.oracle_sql()[name]) is None
    assert any((on_cluster / "threadloom").iterdir())
