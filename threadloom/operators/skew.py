"""Equi lookups that stay balanced when keys hold much of the data.

A sketch over hashed keys rides along as an observed metric while another job
writes its rows, and tells whether any key is hot at all. Only then are the hot keys
counted, exactly and in any number, into a small table of salts. A lookup joins that
table to both sides: the rows of a hot key are spread over its salts, and only the
matching row of the unique side is repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.lineage import cut

HOT_ROWS = 2_000_000  # rows of one key that a single task handles comfortably
TRACKED = 50_000  # sketch size: a key above 1/50000 of the rows cannot be missed
BROADCAST_BYTES = 32 << 20


def most_frequent(keys: list[str], where: Column | None = None) -> Column:
    """Aggregate for ``observe``: the most frequent key hash with its count, estimated from above."""
    hashed = F.xxhash64(*keys)
    if where is not None:
        hashed = F.when(where, hashed)
    return F.call_function("approx_top_k", hashed, F.lit(1), F.lit(TRACKED))


def salts_for(rows: DataFrame, keys: list[str], metric, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """(keys, ``_salts``) of all keys of more than ``hot_rows`` rows; None if ``metric`` rules them out."""
    if not any(r["item"] is not None and r["count"] > hot_rows for r in metric or []):
        return None
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_rows)
    return cut(counts.select(*keys, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts")), "salts")


def salted(rows: DataFrame, salts: DataFrame, on: list[str], spread_by: list[str]) -> DataFrame:
    """Rows with ``_salt``, 0 where their key is not hot."""
    known = rows.join(broadcast_if_small(salts), on, "left")
    return known.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.coalesce("_salts", F.lit(1))).cast("int")).drop("_salts")


def lookup(
    rows: DataFrame,
    unique: DataFrame,
    on: list[str],
    salts: DataFrame | None,
    spread_by: list[str],
    how: str = "inner",
) -> DataFrame:
    """Join ``rows`` to ``unique`` (one row per key) with hot keys split.

    ``spread_by`` names columns of ``rows`` that vary within a key.
    """
    if salts is None:
        return rows.join(unique, on, how)
    repeated = unique.join(broadcast_if_small(salts), on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    )
    return salted(rows, salts, on, spread_by).join(repeated.drop("_salts"), on + ["_salt"], how).drop("_salt")


def size_in_bytes(df: DataFrame) -> int:
    """The planner's size of ``df``; of a written table that of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A written table marked for broadcast if its files hold at most ``max_bytes``.

    Beyond that it is returned unmarked and joins by shuffle.
    """
    return F.broadcast(df) if size_in_bytes(df) <= max_bytes else df
