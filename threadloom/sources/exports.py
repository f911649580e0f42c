"""Reading chat exports and user lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.schemas import EXPORT, USERS


def read_export(spark: SparkSession, path: str | list[str], multiline: bool = True) -> DataFrame:
    """Nested JSON exports under the declared schema.

    ``multiline=True`` reads one document per file, so files are the unit of
    parallelism. ``multiline=False`` reads one document per line; such files are
    split over tasks and suit very large archives.
    """
    return read_documents(spark, path, multiline).drop("document")


def read_documents(spark: SparkSession, path: str | list[str], multiline: bool = True) -> DataFrame:
    """``read_export`` with ``document``: the text of documents that are no valid JSON, else NULL."""
    schema = T.StructType([*EXPORT.fields, T.StructField("document", T.StringType())])
    return spark.read.schema(schema).option("multiLine", multiline).option("columnNameOfCorruptRecord", "document").json(path)


def is_unreadable() -> Column:
    return F.col("document").isNotNull() & F.col("chats").isNull()


def unreadable(spark: SparkSession, path: str | list[str], multiline: bool = True) -> DataFrame:
    """Documents of an export that are no valid JSON: (document), one row each.

    ``read_export`` gives no chats for them.
    """
    return read_documents(spark, path, multiline).filter(is_unreadable()).select("document")


def read_users_csv(spark: SparkSession, path: str) -> DataFrame:
    """User list as CSV with header, quotes doubled inside quoted fields."""
    return spark.read.schema(USERS).option("header", True).option("escape", '"').csv(path)
