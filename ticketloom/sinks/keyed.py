"""Tables that grow by batches and are merged by key.

    <root>/writer=<w>/batch=<n>/...             delivered batches, replaced as a whole
    <root>/_live/generation=<v>/bucket=<b>/...  merged rows, one per key, by hash of the key
    <root>/_manifest/version=<v>/               which generation of each bucket is live, which batches it holds

A merge rewrites only the buckets that its batches touch and writes its manifest last: one that stops half way leaves
files that no manifest names. Manifests state how many rows they have, so that a partial one is never believed. One
merge runs at a time, and not while a batch is being written.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.session import PARQUET_CODEC, path_exists, remove_path, written

#: Buckets of every keyed table. The layout depends on it, so it is no parameter.
BUCKETS = 64
_MANIFEST = "version long, entries long, bucket int, generation long, writer string, batch long"


class Manifest(NamedTuple):
    """``live``: generation per bucket; ``merged``: batches per writer that the live rows include."""

    version: int
    live: dict[int, int]
    merged: dict[str, list[int]]


def bucket_of(key: str | Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def buckets_of(keys: DataFrame) -> list[int]:
    """The buckets that hold the keys of a batch: at most ``BUCKETS`` numbers."""
    return sorted(r[0] for r in keys.select(bucket_of("key")).distinct().collect())


def batch_path(folder: str, writer: str, batch: int) -> str:
    """Where a batch lies: every writer has its own numbers, so that a job and a stream never share one."""
    return f"{folder}/writer={writer}/batch={batch}"


def read_manifest(spark: SparkSession, root: str) -> Manifest:
    """The latest complete manifest."""
    if not path_exists(spark, f"{root}/_manifest"):
        return Manifest(0, {}, {})
    rows = spark.read.schema(_MANIFEST).json(f"{root}/_manifest")
    whole = rows.groupBy("version").agg(F.count(F.lit(1)).alias("n"), F.max("entries").alias("entries")).where("n = entries")
    version = whole.agg(F.max("version")).first()[0]
    if version is None:
        return Manifest(0, {}, {})
    live, merged = {}, {}
    for r in rows.where(F.col("version") == version).collect():
        if r["bucket"] is not None:
            live[r["bucket"]] = r["generation"]
        elif r["writer"] is not None:
            merged.setdefault(r["writer"], []).append(r["batch"])
    return Manifest(version, live, merged)


def _write_manifest(spark: SparkSession, root: str, manifest: Manifest) -> None:
    rows = [(b, g, None, None) for b, g in manifest.live.items()] + [(None, None, w, n) for w, ns in manifest.merged.items() for n in ns]
    entries = spark.createDataFrame(rows, "bucket int, generation long, writer string, batch long")
    entries.coalesce(1).select(F.lit(len(rows)).alias("entries"), "*").write.json(f"{root}/_manifest/version={manifest.version}")


def _partitioned(schema: T.StructType, *names: str) -> T.StructType:
    types = {"bucket": T.IntegerType(), "batch": T.LongType(), "generation": T.LongType(), "writer": T.StringType()}
    return T.StructType([f for f in schema.fields if f.name not in names] + [T.StructField(n, types[n]) for n in names])


def read_batches(spark: SparkSession, root: str, schema: T.StructType, without: dict[str, list[int]] | None = None,
                 only: tuple[str, int] | None = None, buckets: list[int] | None = None) -> DataFrame:
    """Delivered rows with ``writer`` and ``batch``: all, those not in ``without``, or ``only`` one batch, whose folder alone is listed.

    ``buckets`` skips the folders of others, where batches are written with buckets.
    """
    path = root if only is None else batch_path(root, *only)
    names = ["writer", "batch"] + ([] if buckets is None else ["bucket"])
    whole = _partitioned(schema, *names)
    if not path_exists(spark, path):
        return spark.createDataFrame([], _partitioned(schema, "writer", "batch"))
    rows = spark.read.schema(whole).option("basePath", root).parquet(path)
    for writer, numbers in (without or {}).items():
        rows = rows.where((F.col("writer") != writer) | ~F.col("batch").isin(numbers))
    rows = rows if buckets is None else rows.where(F.col("bucket").isin(buckets))
    return rows.select(*_partitioned(schema, "writer", "batch").fieldNames())


def read_live(spark: SparkSession, root: str, schema: T.StructType, manifest: Manifest, buckets: list[int] | None = None) -> DataFrame:
    """Merged rows, one per key, with the ``writer`` and ``batch`` they came from."""
    whole = _partitioned(schema, "writer", "batch", "generation", "bucket")
    paths = [f"{root}/_live/generation={g}/bucket={b}" for b, g in manifest.live.items() if buckets is None or b in buckets]
    if not paths:
        return spark.createDataFrame([], whole).drop("generation", "bucket")
    return spark.read.schema(whole).option("basePath", f"{root}/_live").parquet(*paths).drop("generation", "bucket")


def merge_batches(spark: SparkSession, root: str, schema: T.StructType, newest: Callable[[DataFrame], DataFrame],
                  order: tuple[str, ...] = ()) -> int:
    """Merge the batches that were delivered since the last merge; ``newest`` picks one row per key. Returns the version.

    ``order`` sorts the rows of a file, so that filters on those columns skip by its statistics.
    """
    known = read_manifest(spark, root)
    pending = read_batches(spark, root, schema, without=known.merged)
    taken = [(r["writer"], r["batch"]) for r in pending.select("writer", "batch").distinct().collect()]  # one row per batch
    if not taken:
        return known.version
    version, touched = known.version + 1, buckets_of(pending)
    rows = newest(pending.unionByName(read_live(spark, root, schema, known, touched))).withColumn("bucket", bucket_of("key"))
    # a bucket is a few files; adaptive execution splits a large one
    rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", *order).write.mode("overwrite").option(
        "partitionOverwriteMode", "static").option("compression", PARQUET_CODEC).partitionBy("bucket").parquet(f"{root}/_live/generation={version}")
    merged = {w: list(ns) for w, ns in known.merged.items()}
    for writer, batch in taken:
        merged.setdefault(writer, []).append(batch)
    _write_manifest(spark, root, Manifest(version, known.live | dict.fromkeys(touched, version), merged))
    return version


def read_newest(spark: SparkSession, root: str, schema: T.StructType, newest: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """One row per key. Right after a merge that is a plain scan; later only the batches since then are sorted out, and
    the live rows of their keys."""
    manifest = read_manifest(spark, root)
    pending = read_batches(spark, root, schema, without=manifest.merged)
    if not manifest.version:
        return newest(pending)
    live = read_live(spark, root, schema, manifest)
    if pending.isEmpty():
        return live
    keys = written(pending.select("key").distinct(), "store-keys")
    return live.join(keys, "key", "left_anti").unionByName(newest(live.join(keys, "key", "left_semi").unionByName(pending)))


def drop_merged(spark: SparkSession, root: str) -> None:
    """Delete batches that are merged, and generations and manifests that no bucket needs; history ends there."""
    manifest = read_manifest(spark, root)
    for writer, numbers in manifest.merged.items():
        for batch in numbers:
            remove_path(spark, batch_path(root, writer, batch))
    for version in range(1, manifest.version):
        if version not in manifest.live.values():
            remove_path(spark, f"{root}/_live/generation={version}")
        remove_path(spark, f"{root}/_manifest/version={version}")
