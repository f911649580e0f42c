"""Cutting lineage with tables in the cluster's shared checkpoint folder.

Iterative jobs write each round as Parquet and read it back: the written files
survive the loss of any executor, carry size statistics for join planning, and
keep every round's plan short.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession

_local_fallback: dict[str, str] = {}
_found_shared: set[tuple[str, str]] = set()
_running = threading.local()  # .jobs: paths of this thread's running jobs, innermost last


def _open_jobs() -> list[list[str]]:
    if not hasattr(_running, "jobs"):
        _running.jobs = []
    return _running.jobs


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir`` (or set on the context).

    A path that names no file system is on Hadoop's default one, as everywhere in
    Spark. If that is the machines' own disk, the first use tests that all of them
    share the folder. Only a local-mode session without either setting falls back to
    a temporary folder, since driver and executors then share one machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    local = spark.sparkContext.master.startswith("local")
    if folder:
        if not local and ":" not in folder:
            folder = _on_default_system(spark, folder)
        return folder.rstrip("/")
    if not local:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_fallback:
        _local_fallback[app] = tempfile.mkdtemp(prefix="threadloom-")
    return _local_fallback[app]


def _on_default_system(spark: SparkSession, folder: str) -> str:
    """``folder`` with its file system; an error if executors do not share it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    if whole.startswith("file:") and (key := (spark.sparkContext.applicationId, whole)) not in _found_shared:
        if not is_shared(spark, whole):
            raise ValueError(f"{folder} is a folder of each machine by itself; set spark.checkpoint.dir to one that all executors can reach")
        _found_shared.add(key)
    return whole


def is_shared(spark: SparkSession, folder: str) -> bool:
    """Whether the driver finds, and tasks read, what all tasks write there."""
    path, tasks = f"{folder.rstrip('/')}/threadloom/shared-{uuid.uuid4().hex}", 2 * spark.sparkContext.defaultParallelism
    try:
        spark.range(0, tasks, 1, tasks).write.parquet(path)
        return spark.read.schema("id long").parquet(path).count() == tasks
    except (PySparkException, Py4JJavaError):  # the commit or a reader misses files
        return False
    finally:
        drop(spark, [path])


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    path = f"{shared_folder(spark)}/threadloom/{label}-{uuid.uuid4().hex}"
    if _open_jobs():
        _open_jobs()[-1].append(path)
    return path


@contextmanager
def job(spark: SparkSession) -> Iterator[None]:
    """Deletes the paths made inside when it ends, also after a failure.

    For jobs that write or collect their results before the end: what still reads
    a path made inside cannot run afterwards.
    """
    with recorded() as paths:
        try:
            yield
        finally:
            drop(spark, paths)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """Lists the paths made inside, for a later ``drop``."""
    paths: list[str] = []
    _open_jobs().append(paths)
    try:
        yield paths
    finally:
        _open_jobs().pop()


def drop(spark: SparkSession, paths: list[str]) -> None:
    """Deletes intermediate tables; those that are gone already are passed over."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cut(df: DataFrame, label: str, observation: Observation | None = None, *metrics) -> DataFrame:
    """Write ``df`` once and return a DataFrame over the written table.

    ``metrics`` are aggregates computed during the write; read them from
    ``observation.get`` afterwards.
    """
    path = fresh_path(df.sparkSession, label)
    observed = df.observe(observation, *metrics) if metrics else df
    observed.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for what runs inside; plans that run later see the old ones."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
