"""Versions of a stored table.

A version is a small numbered file under ``_versions`` that names the folders of
its data. It is written aside and renamed, so it is there whole or not at all: a
commit is that one rename. Data folders are never changed once a version names
them, so a reader that took a version keeps reading it while others commit.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

FOLDER = "_versions"


def files(spark: SparkSession, path: str):
    """A path for the JVM, and the file system it is on."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = files(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p, fs = files(spark, path)
    fs.delete(p, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing if it is absent."""
    p, fs = files(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _file(base: str, number: int) -> str:
    return f"{base}/{FOLDER}/{number:012d}"


def versions(spark: SparkSession, base: str) -> list[int]:
    """Committed versions, oldest first."""
    return sorted(int(n) for n in names(spark, f"{base}/{FOLDER}") if n.isdigit())


def read_version(spark: SparkSession, base: str, number: int | None = None, before: int | None = None) -> tuple[int, dict] | None:
    """The version ``number``, or the last one (below ``before``); None if there is none."""
    there = [v for v in versions(spark, base) if (number is None or v == number) and (before is None or v < before)]
    if not there:
        return None
    p, fs = files(spark, _file(base, there[-1]))
    stream = fs.open(p)
    try:
        return there[-1], json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def commit(spark: SparkSession, base: str, number: int, content: dict) -> None:
    """Make ``content`` version ``number``; another writer's version of that number is an error."""
    target, fs = files(spark, _file(base, number))
    aside, _ = files(spark, f"{base}/{FOLDER}/.{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()
    if fs.exists(target) or not fs.rename(aside, target):
        fs.delete(aside, False)
        raise OSError(f"version {number} of {base} was committed by another writer")


def drop_old(spark: SparkSession, base: str, keep: int, folders) -> None:
    """Delete all but the last ``keep`` versions, and the folders that only those name.

    ``folders(content)`` lists the folders a version names, relative to ``base``.
    Folders that no version names yet are left alone: they belong to a running write.
    """
    there = versions(spark, base)
    old, kept = there[:-keep], there[-keep:]
    if not old:
        return
    contents = {v: read_version(spark, base, v)[1] for v in there}
    held = {f for v in kept for f in folders(contents[v])}
    for v in old:
        for folder in set(folders(contents[v])) - held:
            delete(spark, f"{base}/{folder}")
        delete(spark, _file(base, v))
