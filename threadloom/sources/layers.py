"""Stored tables ("layers") under a base folder: read, replace, append, upsert.

Every write adds folders and commits a version (``versions``) that names the data.
Readers pin the version they start with; ``KEEP`` versions stay readable. A layer
that was upserted is dealt into buckets by a hash of its keys, and later upserts
rewrite the buckets of their keys only.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.lineage import cut, job
from threadloom.operators.messages import dedupe
from threadloom.operators.skew import BROADCAST_BYTES, size_in_bytes
from threadloom.sources.versions import commit, delete, drop_old, names, path_exists, read_version

KEEP = 3  # versions of a layer that stay readable
BUCKETS = 64  # of a layer that is first upserted
BUCKET = "__bucket"


def _path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def _place(part: dict) -> str:
    return part["folder"] + (f"/{BUCKET}={part['bucket']}" if "bucket" in part else "")


def _folders(content: dict) -> list[str]:
    return [_place(p) for p in content["parts"]]


def _commit(spark: SparkSession, path: str, number: int, content: dict, added: list[dict]) -> None:
    """Commit a version; if another writer came first, what this one added goes."""
    try:
        commit(spark, path, number, content)
    except OSError:
        for folder in {p["folder"] for p in added}:
            delete(spark, f"{path}/{folder}")
        raise
    drop_old(spark, path, KEEP, _folders)


def _refuse_plain(spark: SparkSession, path: str) -> None:
    """Rows cannot join a folder without versions, as readers would not see them together."""
    if any(not n.startswith(("_", ".", "data-")) for n in names(spark, path)):
        raise ValueError(f"{path} holds files without versions; replace it by write_layer first")


def write_layer(
    df: DataFrame | None,
    base: str,
    name: str,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
) -> int:
    """Replace a layer and return its row count; nothing to write keeps the old data.

    The rows are counted on the way into a new folder, and a version that names it
    is committed only when it is complete: a failed or empty run leaves the layer as
    it was and no folder behind, and ``df`` may read the layer it replaces.
    """
    if df is None:
        return 0
    spark, path = df.sparkSession, _path(base, name)
    folder = f"data-{uuid.uuid4().hex}"
    count = _write_folder(df, f"{path}/{folder}", fmt, partition_by)
    if count == 0:
        return 0
    now = read_version(spark, path)
    content = {"format": fmt, "schema": df.schema.json(), "parts": [{"folder": folder, "rows": count}]}
    _commit(spark, path, now[0] + 1 if now else 0, content, content["parts"])
    return count


def _write_folder(df: DataFrame, folder: str, fmt: str, partition_by: list[str] | None = None) -> int:
    """Write one folder and count its rows; a failed or empty write leaves nothing."""
    spark, seen = df.sparkSession, Observation()
    rows = df.observe(seen, F.count("*").alias("rows"))
    try:
        if partition_by:
            # Few files per folder; a folder with much data is still written by many tasks.
            rows.hint("rebalance", *partition_by).write.format(fmt).partitionBy(*partition_by).save(folder)
        else:
            rows.write.format(fmt).save(folder)
    except Exception:
        delete(spark, folder)
        raise
    # A plan that Spark finds to be empty loses its observation.
    count = seen.get["rows"] if seen._jo.getRow().length() else spark.read.schema(df.schema).format(fmt).load(folder).count()
    if count == 0:
        delete(spark, folder)
    return count


def write_store(df: DataFrame | None, fmt: str, **options: str) -> int:
    """Replace a collection of an external store through its Spark connector.

    The same rules as ``write_layer``; the connector must be on the class path,
    for a document store for instance ``fmt="mongodb", database=…, collection=…``.
    """
    if df is None:
        return 0
    seen = Observation()
    rows = cut(df, "store-rows", seen, F.count("*").alias("rows"))
    if seen.get["rows"] == 0:
        return 0
    rows.write.format(fmt).mode("overwrite").options(**options).save()
    return seen.get["rows"]


def write_all(
    users: DataFrame | None, threads: DataFrame | None, messages: DataFrame | None, base: str
) -> DataFrame:
    """Write the three layers; returns (layer, row_count)."""
    spark = next(d for d in (users, threads, messages) if d is not None).sparkSession
    counts = [
        (name, write_layer(df, base, name))
        for name, df in (("users", users), ("threads", threads), ("messages", messages))
    ]
    return spark.createDataFrame(counts, "layer string, row_count bigint")


def _schema(content: dict) -> T.StructType:
    return T.StructType.fromJson(json.loads(content["schema"]))


def _read_parts(spark: SparkSession, path: str, content: dict, parts: list[dict]) -> DataFrame:
    """Rows of some parts; columns that a part was written without are NULL."""
    if not parts:
        return spark.createDataFrame([], _schema(content))
    return spark.read.format(content["format"]).schema(_schema(content)).load([f"{path}/{_place(p)}" for p in parts])


def layer_version(spark: SparkSession, base: str, name: str) -> int | None:
    """The last committed version of a layer, for ``read_layer``."""
    now = read_version(spark, _path(base, name))
    return now[0] if now else None


def read_layer(spark: SparkSession, base: str, name: str, fmt: str = "parquet", version: int | None = None) -> DataFrame:
    """A layer as of its last version, or of ``version`` while that is kept.

    A folder without versions is read as it is, in the format ``fmt``.
    """
    path = _path(base, name)
    now = read_version(spark, path, version)
    if now is None:
        if version is not None:
            raise ValueError(f"{path} holds no version {version}")
        return spark.read.format(fmt).load(path)
    return _read_parts(spark, path, now[1], now[1]["parts"])


def append_layer(df: DataFrame, base: str, name: str, fmt: str = "parquet") -> int:
    """Add rows to a layer, or create it, and return how many were added.

    The rows join the layer in one commit, under its column types. A layer with
    buckets takes them into the buckets of their keys.
    """
    spark, path = df.sparkSession, _path(base, name)
    now = read_version(spark, path)
    if now is None:
        _refuse_plain(spark, path)
        return write_layer(df, base, name, fmt)
    number, content = now
    if sorted(df.columns) != sorted(_schema(content).names):
        raise ValueError(f"columns {df.columns} are not those of {path}")
    rows = df.select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in _schema(content)))
    if "keys" in content:
        added = _write_buckets(rows, path, content)
    else:
        folder = f"data-{uuid.uuid4().hex}"
        count = _write_folder(rows, f"{path}/{folder}", content["format"])
        added = [{"folder": folder, "rows": count}] if count else []
    if added:
        _commit(spark, path, number + 1, content | {"parts": content["parts"] + added}, added)
    return sum(p["rows"] for p in added)


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _write_buckets(rows: DataFrame, path: str, content: dict) -> list[dict]:
    """Write rows into the buckets of their keys; one part per bucket."""
    spark, folder = rows.sparkSession, f"data-{uuid.uuid4().hex}"
    dealt = rows.withColumn(BUCKET, _bucket(content["keys"], content["buckets"]))
    if not _write_folder(dealt, f"{path}/{folder}", content["format"], [BUCKET]):
        return []
    written = spark.read.format(content["format"]).schema(dealt.schema).load(f"{path}/{folder}")
    counts = written.groupBy(BUCKET).count().collect()  # one row per bucket
    return [{"folder": folder, "bucket": r[0], "rows": r[1]} for r in counts]


def one_per_key(rows: DataFrame, keys: list[str], order: list[Column | str] | None = None) -> DataFrame:
    """The first row of each key under ``order``; without it the smallest by its other columns."""
    others = [F.col(c).asc_nulls_last() for c in rows.columns if c not in keys and not _is_map(rows, c)]
    return dedupe(rows, keys, order or others or list(keys))


def _is_map(df: DataFrame, column: str) -> bool:
    return "map<" in df.schema[column].dataType.simpleString()  # maps have no order


def upsert(
    base: DataFrame, updates: DataFrame, keys: list[str], order: list[Column | str] | None = None
) -> DataFrame:
    """Base rows with updates merged in by key.

    An update sets the columns it carries, null included, and leaves the others;
    unknown keys are inserted. ``order`` picks the update that wins when a key
    comes more than once (first under ``order``; without it the smallest by its
    other columns), so keys stay unique.
    """
    return _merge(base, cut(one_per_key(updates, keys, order), "updates"), keys)


def _merge(base: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """``upsert`` of stored updates with one row per key."""
    new = updates.withColumn("_updated", F.lit(True))
    updated = F.col("u._updated").isNotNull()

    def same_key(left: str) -> list[Column]:
        return [F.col(f"{left}.{k}").eqNullSafe(F.col(f"u.{k}")) for k in keys]

    def merged(name: str) -> Column:
        if name not in updates.columns:
            return F.col(f"b.{name}").alias(name)
        if name not in base.columns:
            return F.col(f"u.{name}").alias(name)
        return F.when(updated, F.col(f"u.{name}")).otherwise(F.col(f"b.{name}")).alias(name)

    names = base.columns + [c for c in updates.columns if c not in base.columns]
    columns = [merged(n) for n in names]
    old, u = base.alias("b"), new.alias("u")
    if size_in_bytes(updates) > BROADCAST_BYTES:
        return old.join(u, same_key("b"), "full_outer").select(*columns)
    # Few updates: the base is scanned in place instead of being shuffled.
    changed = old.join(F.broadcast(u), same_key("b"), "left").select(*columns)
    known = cut(
        base.select(*keys).alias("b").join(F.broadcast(u), same_key("b"), "left_semi"), "known-keys"
    )
    inserted = u.join(known.alias("k"), same_key("k"), "left_anti").drop("_updated")
    return changed.unionByName(inserted, allowMissingColumns=True).select(*names)


def upsert_layer(
    updates: DataFrame, base: str, name: str, keys: list[str],
    order: list[Column | str] | None = None, buckets: int = BUCKETS,
) -> int:
    """Upsert into a stored layer, creating it when absent; returns its row count.

    The first upsert deals the layer into ``buckets`` by a hash of the keys. Later
    ones by the same keys read and rewrite only the buckets that hold keys of
    updates; the files of all others stay as they are. Columns keep the layer's
    types, and columns that only updates carry are added to it.
    """
    with job(updates.sparkSession):
        return _upsert_layer(updates, _path(base, name), keys, order, buckets)


def _upsert_layer(
    updates: DataFrame, path: str, keys: list[str], order: list[Column | str] | None, buckets: int
) -> int:
    spark = updates.sparkSession
    now = read_version(spark, path)
    first = one_per_key(updates, keys, order)
    if now is None:
        _refuse_plain(spark, path)
    held = _schema(now[1]) if now else T.StructType()
    new = cut(
        first.select(*(F.col(f"`{c}`").cast(held[c].dataType).alias(c) if c in held.names else F.col(f"`{c}`") for c in first.columns)),
        "updates",
    )
    schema = T.StructType(held.fields + [f for f in new.schema if f.name not in held.names])
    if now and now[1].get("keys") == keys:
        content = now[1] | {"schema": schema.json()}
        touched = {r[0] for r in new.select(_bucket(keys, content["buckets"])).distinct().collect()}  # one number per bucket
        stale = [p for p in content["parts"] if p["bucket"] in touched]
        left = [p for p in content["parts"] if p["bucket"] not in touched]
    else:
        content = {"format": now[1]["format"] if now else "parquet", "schema": schema.json(), "keys": keys, "buckets": buckets}
        stale, left = now[1]["parts"] if now else [], []
    if stale:
        rows = _merge(_read_parts(spark, path, now[1], stale), new, keys)
    else:
        rows = new
    rows = rows.select(*(F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema))
    added = _write_buckets(rows, path, content)
    if not added:  # no updates
        return sum(p["rows"] for p in now[1]["parts"]) if now else 0
    parts = left + added
    _commit(spark, path, now[0] + 1 if now else 0, content | {"parts": parts}, added)
    return sum(p["rows"] for p in parts)


def export_csv(df: DataFrame, columns: list[str], path: str) -> None:
    """Chosen columns as CSV with header; quotes are doubled, line breaks kept."""
    df.select(*columns).write.option("header", True).option("escape", '"').csv(path)
