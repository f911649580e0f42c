"""Bucketed tables that a stream keeps between batches.

A table is dealt into buckets by a hash of its key. Every batch adds one part to
the buckets it has rows for, so a lookup reads the parts of the buckets of its
keys and no others. All tables of a batch become visible by one commit
(``sources.versions``). Parts are merged in levels: ``FAN_IN`` parts of a bucket
become one of the next level, and a row is rewritten once per level, however many
batches follow. Buckets take turns, so no batch merges all of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.sources.versions import commit, drop_old, names, read_version

FAN_IN = 8
BUCKETS = 32
KEEP = 3  # commits that stay readable
BUCKET = "__bucket"
Merger = Callable[[DataFrame, list[int]], DataFrame]


class Tables:
    """The tables of a stream as of its last commit before ``batch`` (the last one, if None).

    ``schemas`` gives the columns of each table, ``keys`` the columns it is dealt by.
    """

    def __init__(
        self, spark: SparkSession, path: str, schemas: dict[str, str], keys: dict[str, list[str]],
        batch: int | None = None, buckets: int = BUCKETS,
    ):
        self.spark, self.path, self.schemas, self.keys, self.batch = spark, path.rstrip("/"), schemas, keys, batch
        found = read_version(spark, self.path, before=batch)
        content = found[1] if found else {"buckets": buckets, "tables": {}}
        self.committed = found[0] if found else None
        self.buckets: int = content["buckets"]
        #: table → bucket → [folder, level] of its parts
        self.parts = {t: {int(b): list(p) for b, p in content["tables"].get(t, {}).items()} for t in schemas}

    def bucket(self, *columns: str | Column) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame, *columns: str) -> list[int]:
        """Buckets of these key values: at most one number per bucket."""
        return sorted(r[0] for r in rows.select(self.bucket(*columns)).distinct().collect())

    def _places(self, table: str, parts: dict[int, list]) -> list[str]:
        return [f"{self.path}/{table}/{folder}/{BUCKET}={b}" for b, held in sorted(parts.items()) for folder, _ in held]

    def read(self, table: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """Rows of a table, of these buckets only if given, including what this batch added."""
        parts = self.parts[table]
        return self._load(table, parts if buckets is None else {b: parts.get(b, []) for b in buckets})

    def _load(self, table: str, parts: dict[int, list]) -> DataFrame:
        places = self._places(table, parts)
        if not places:
            return self.spark.createDataFrame([], self.schemas[table])
        return self.spark.read.schema(self.schemas[table]).parquet(*places)

    def _write(self, table: str, rows: DataFrame) -> tuple[str, list[int]]:
        """Folder of newly written rows, and the buckets it has."""
        folder = f"{self.batch}-{uuid.uuid4().hex}"
        columns = self.spark.createDataFrame([], self.schemas[table]).columns
        dealt = rows.select(*columns).withColumn(BUCKET, self.bucket(*self.keys[table]))
        # One file per bucket, unless a bucket is large.
        dealt.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/{table}/{folder}")
        there = names(self.spark, f"{self.path}/{table}/{folder}")
        return folder, [int(n.split("=")[1]) for n in there if n.startswith(BUCKET)]

    def add(self, rows: dict[str, DataFrame]) -> None:
        """Add a part to each of some tables; the small writes run side by side."""
        with ThreadPoolExecutor(len(rows)) as pool:
            written = list(pool.map(lambda table: self._write(table, rows[table]), rows))
        for table, (folder, buckets) in zip(rows, written):
            for b in buckets:
                self.parts[table].setdefault(b, []).append([folder, 0])

    def merge(self, merged: dict[str, Merger]) -> None:
        """Merge parts of the buckets whose turn it is, in each of some tables.

        ``merged[table](rows, buckets)`` reduces rows of some parts of these buckets to
        equivalent ones, and may leave out rows that nothing asks for any more.
        """
        with ThreadPoolExecutor(len(merged)) as pool:
            list(pool.map(lambda table: self._merge(table, merged[table]), merged))

    def _merge(self, table: str, merged: Merger) -> None:
        chosen: dict[int, list] = {}
        levels: dict[int, int] = {}
        for b, held in self.parts[table].items():
            if self.batch % FAN_IN != b % FAN_IN:
                continue
            level, taken = 0, []
            # A level joins in when it would be full.
            while (there := [p for p in held if p[1] == level]) and (level == 0 or len(there) >= FAN_IN - 1):
                taken, level = taken + there, level + 1
            if len(taken) > 1:
                chosen[b], levels[b] = taken, level
        if not chosen:
            return
        folder, buckets = self._write(table, merged(self._load(table, chosen), sorted(chosen)))
        for b, taken in chosen.items():
            self.parts[table][b] = [p for p in self.parts[table][b] if p not in taken]
            if b in buckets:
                self.parts[table][b].append([folder, levels[b]])

    def commit(self) -> None:
        content = {"buckets": self.buckets, "tables": self.parts}
        commit(self.spark, self.path, self.batch, content)
        drop_old(self.spark, self.path, KEEP, lambda c: [
            f"{t}/{folder}/{BUCKET}={b}" for t, held in c["tables"].items() for b, parts in held.items() for folder, _ in parts
        ])
