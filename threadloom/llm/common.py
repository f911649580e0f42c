"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.lineage import cut

ROW = "__llm_row"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def numbered(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` with a unique row number and read it back.

    The number is a stored value, so later jobs and retried tasks agree on it
    even where ids repeat or are NULL.
    """
    return cut(df.withColumn(ROW, F.monotonically_increasing_id()), label)


def shuffle_tasks(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def dealt(df: DataFrame, rows: int, per_task: int) -> DataFrame:
    """Deal rows round-robin so that no task holds more than about ``per_task``.

    Spark sorts before it deals, so a retried task sends the same rows.
    """
    return df.repartition(max(shuffle_tasks(df.sparkSession), math.ceil(rows / per_task)))
