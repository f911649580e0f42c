"""Calling user-supplied model functions from Spark tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from threadloom.functions.text import batch_number
from threadloom.lineage import cut, job
from threadloom.sources.layers import append_layer, layer_version, read_layer, upsert_layer


def map_model(
    df: DataFrame,
    fn: Callable[[dict], Any],
    keys: list[str],
    result_type: str,
    concurrency: int = 4,
) -> DataFrame:
    """One call of ``fn(row as dict)`` per row, no retry.

    Returns ``keys``, ``result`` (``result_type``) and ``error``; exactly one of the
    two is set. An exception, no answer (None), and an answer that is not of the
    result type are errors of that row alone. Calls of a batch overlap on ``concurrency`` threads, as model calls
    mostly wait. The result is written once, so that later readers do not repeat
    the calls.
    """
    result = T._parse_datatype_string(result_type)
    schema = _result_schema(df, keys, result)
    arrow_result = to_arrow_type(result)

    def call(row: dict) -> tuple[Any, str | None]:
        try:
            answer = fn(row)
            if answer is None:
                return None, "NoAnswer: None"
            pa.array([answer], type=arrow_result)  # else one answer would fail the batch
            return answer, None
        except Exception as e:  # a failed item must not fail its task
            return None, f"{type(e).__name__}: {e}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(concurrency) as pool:
            for batch in batches:
                got = list(pool.map(call, batch.to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k) for k in keys]
                    + [
                        pa.array([r for r, _ in got], type=arrow_result),
                        pa.array([e for _, e in got], type=pa.string()),
                    ],
                    names=[*keys, "result", "error"],
                )

    return cut(df.mapInArrow(run, schema), "model-results")


def _result_schema(df: DataFrame, keys: list[str], result: T.DataType) -> T.StructType:
    return T.StructType([df.schema[k] for k in keys] + [T.StructField("result", result), T.StructField("error", T.StringType())])


def map_model_logged(
    df: DataFrame,
    fn: Callable[[dict], Any],
    keys: list[str],
    result_type: str,
    base: str,
    name: str,
    batches: int = 16,
    retry_errors: bool = False,
    concurrency: int = 4,
) -> DataFrame:
    """``map_model`` that calls once per row over any number of runs.

    Answers are a stored layer, keyed by a hash of the whole row and of the result
    type. Rows that it lists are not called again; the others are called in ``batches``
    by a hash of the row, each committed as it ends. A run that dies, in a task or on the
    driver, loses the calls of one batch at most, and the next run goes on after it.
    Changed rows are new rows. Errors are answers too, unless ``retry_errors``.
    """
    spark = df.sparkSession
    call = F.md5(F.concat(F.lit(f"{result_type}:"), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})))
    rows = cut(df.withColumn("_call", call), "model-calls")
    schema = _result_schema(df, keys, T._parse_datatype_string(result_type))

    def known() -> DataFrame:
        if layer_version(spark, base, name) is None:
            return spark.createDataFrame([], T.StructType([T.StructField("_call", T.StringType()), *schema.fields]))
        return read_layer(spark, base, name)

    there = known()
    if retry_errors:
        there = there.filter(F.col("error").isNull())
    # Equal rows are one call.
    left = cut(rows.join(there.select("_call"), "_call", "left_anti").dropDuplicates(["_call"]), "model-calls-left")
    turn = batch_number("_call", F.lit(batches))
    for i in range(batches):
        some = left.filter(turn == i)
        if some.isEmpty():
            continue
        with job(spark):
            answers = map_model(some, fn, ["_call", *keys], result_type, concurrency)
            if retry_errors:
                upsert_layer(answers, base, name, ["_call"])
            else:
                append_layer(answers, base, name)  # new calls only
    return rows.select("_call").join(known(), "_call").select(*schema.names)


def succeeded(results: DataFrame) -> DataFrame:
    return results.filter(F.col("error").isNull()).drop("error")


def failed(results: DataFrame) -> DataFrame:
    return results.filter(F.col("error").isNotNull()).drop("result")
