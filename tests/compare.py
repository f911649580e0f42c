"""Row-by-row comparison of a Spark result with DuckDB."""

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def kind(dtype: str) -> str:
    """Rough type class, to catch text against number and decimal against double."""
    d = str(dtype).lower()
    for names, k in (
        (("bigint", "long", "int", "integer", "smallint", "tinyint"), "int"),
        (("double", "float"), "float"),
        (("varchar", "string"), "text"),
        (("boolean",), "bool"),
    ):
        if d in names:
            return k
    return d


def differences(spark_df, con, sql: str) -> str | None:
    rel = con.sql(sql)
    left_cols, right_cols = sorted(spark_df.columns), sorted(rel.columns)
    if left_cols != right_cols:
        return f"columns {left_cols} != {right_cols}"
    left_types = {c: kind(d) for c, d in spark_df.dtypes}
    right_types = {c: kind(d) for c, d in zip(rel.columns, rel.types)}
    if left_types != right_types:
        return f"types {left_types} != {right_types}"
    left = Counter(tuple(plain(r[c]) for c in left_cols) for r in spark_df.collect())
    order = [rel.columns.index(c) for c in left_cols]
    right = Counter(tuple(plain(r[i]) for i in order) for r in rel.fetchall())
    if left == right:
        return None if left else "both sides are empty"
    only_left, only_right = left - right, right - left
    return (
        f"rows {sum(left.values())} vs {sum(right.values())}; "
        f"only spark {sum(only_left.values())}: {str(sorted(only_left, key=str)[:2])[:700]}; "
        f"only sql {sum(only_right.values())}: {str(sorted(only_right, key=str)[:2])[:700]}"
    )
