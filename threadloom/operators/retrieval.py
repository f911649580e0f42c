"""Filter, sort, limit, count and sample stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from threadloom.lineage import cut, settings

RANDOM_SAMPLE = 100  # fixed value: default sample size
PER_STRATUM = 5  # fixed value: default rows per stratum
LIMITED_RANK = 1_000  # Spark limits ranks before the shuffle up to here, unless told otherwise
RANK_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"
SALTS = 64
HIDDEN = ("_id",)  # store ids, left out unless asked for


def find(
    df: DataFrame,
    where: Column | None = None,
    columns: list[str] | None = None,
    sort_by: str | list[Column] | None = None,
    limit: int = 0,
) -> DataFrame:
    """Matching rows; ``sort_by`` a column name sorts descending, ``limit`` 0 keeps all."""
    rows = df if where is None else df.filter(where)
    if sort_by is not None:
        rows = rows.orderBy(*([F.desc(sort_by)] if isinstance(sort_by, str) else sort_by))
    if limit > 0:
        rows = rows.limit(limit)
    return rows.select(*columns) if columns else rows.drop(*HIDDEN)


def find_one(df: DataFrame, where: Column | None, order: list[Column | str]) -> DataFrame:
    """The first match under ``order``; empty when nothing matches."""
    return find(df, where, sort_by=order, limit=1)


def count(df: DataFrame, where: Column | None = None) -> DataFrame:
    rows = df if where is None else df.filter(where)
    return rows.agg(F.count("*").alias("count"))


def load_threads(
    threads: DataFrame, where: Column | None = None, holds: Column | None = None, lacks: Column | None = None
) -> DataFrame:
    """Thread ids with non-empty transcripts, one row per gold row; threads are loaded whole.

    ``where`` is about the thread: its header columns. ``holds`` must be true of some
    part, ``lacks`` of none; these are about texts. So a thread of several parts is
    loaded exactly when it would be as one, as parts are cut between messages (a
    pattern that spans messages is only found within a part). Where threads have parts,
    a ``where`` that names the text is refused by the analyser.
    """
    shown = [c for c in ("thread_id", "part_no", "transcript") if c in threads.columns]
    rows = threads
    if "part_no" not in threads.columns:
        for test in (where, holds, None if lacks is None else ~F.coalesce(lacks, F.lit(False))):
            rows = rows if test is None else rows.filter(test)
        return rows.filter(F.length("transcript") > 0).select(*shown)
    if where is not None:
        whole = headers(threads).drop("transcript", "messages", "messages_json").filter(where).select("thread_id")
        rows = rows.join(whole, "thread_id", "left_semi")
    if holds is not None:
        rows = rows.join(threads.filter(holds).select("thread_id").distinct(), "thread_id", "left_semi")
    if lacks is not None:
        rows = rows.join(threads.filter(lacks).select("thread_id").distinct(), "thread_id", "left_anti")
    return rows.filter(F.length("transcript") > 0).select(*shown)


def headers(threads: DataFrame) -> DataFrame:
    """One row per thread: the first part."""
    return threads.filter(F.col("part_no") == 0) if "part_no" in threads.columns else threads


def larger_than(threads: DataFrame, messages: int) -> DataFrame:
    """Headers of the threads with more messages."""
    return headers(threads).filter(F.col("message_count") > messages)


def stratified_sample(
    df: DataFrame, by: str, order: list[Column | str], n: int = PER_STRATUM
) -> DataFrame:
    """The first ``n`` rows of each group; rows without a group are left out.

    The rank limit also runs before the shuffle: a group of any size sends at
    most ``n`` rows per input partition. Up to ``LIMITED_RANK`` the sample is a plan.
    Beyond, it is written, with Spark's own limit raised meanwhile, and a group that
    many partitions hold is ranked in up to ``SALTS`` parts first: what meets in its last task
    is at most ``SALTS`` times ``n`` rows.
    """
    rows = df.filter(F.col(by).isNotNull())
    if n <= LIMITED_RANK:
        return _first_ranks(rows, [by], order, n)
    with _rank_limit(df.sparkSession, n):
        parts = _first_ranks(rows.withColumn("_salt", F.spark_partition_id() % SALTS), [by, "_salt"], order, n)
        return cut(_first_ranks(parts.drop("_salt"), [by], order, n), "stratified-sample")


def _first_ranks(rows: DataFrame, by: list[str], order: list[Column | str], n: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def _rank_limit(spark: SparkSession, n: int):
    """Let Spark limit ranks of up to ``n`` before the shuffle."""
    return settings(spark, {RANK_LIMIT: str(max(n, int(spark.conf.get(RANK_LIMIT, "0"))))})


def random_sample(
    df: DataFrame, key: list[str], n: int = RANDOM_SAMPLE, seed: str = "0"
) -> DataFrame:
    """``n`` rows in the order of a seeded hash of the key: random, yet repeatable."""
    draw = F.md5(F.concat_ws(":", F.lit(seed), *key))
    return df.orderBy(draw, *key).limit(n)


def group_slice(
    df: DataFrame, by: str, order: list[Column | str], n: int, fields: list[str]
) -> DataFrame:
    """Match, group with pushed items, and slice: ``items`` holds the first ``n`` rows."""
    kept = stratified_sample(df, by, order, n)
    rank = F.row_number().over(W.partitionBy(by).orderBy(*order))
    item = F.struct(F.col("_pos"), F.struct(*fields).alias("item"))
    grouped = kept.withColumn("_pos", rank).groupBy(by).agg(F.collect_list(item).alias("_items"))
    return grouped.select(by, F.transform(F.sort_array("_items"), lambda x: x["item"]).alias("items"))


def unwind(df: DataFrame, column: str = "items") -> DataFrame:
    """One row per array entry, with the entry as the new row."""
    return df.select(F.explode(column).alias("_row")).select("_row.*")
