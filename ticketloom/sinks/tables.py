"""Stored shape, issue store, corpus and state writers.

Store and state are written in one folder per batch and only ever replaced batch by batch: running a
batch again gives the same tables, whatever part of it had been written before. Small batches are merged by
key now and then (``keyed``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.functions.times import stored_format
from ticketloom.operators.dedupe import dedupe_latest
from ticketloom.schema import ISSUE_COLUMNS, PROCESSED_SCHEMA
from ticketloom.session import PARQUET_CODEC, path_exists
from ticketloom.sinks.keyed import batch_path, bucket_of, merge_batches, read_batches, read_newest
from ticketloom.sources.issues import parse_issue

_ISSUES = T.StructType(ISSUE_COLUMNS)
STORE_SCHEMA = T.StructType(ISSUE_COLUMNS + [T.StructField("writer", T.StringType()), T.StructField("batch", T.LongType())])


def _object(raw: Column | None, paths: list[str], typed: Column, required: bool) -> Column:
    """The whole object of the raw document; else one made of the typed name."""
    empty = F.parse_json(F.lit("{}"))
    if raw is None:
        return F.coalesce(typed, empty) if required else typed
    found = F.coalesce(*[F.try_variant_get(raw, p, "variant") for p in paths])
    return F.coalesce(found, empty) if required else found


def to_stored(issues: DataFrame) -> DataFrame:
    """Typed issues -> ``key, project, fields, comments`` of the raw store.

    With the ``raw`` column the objects keep all attributes the tracker sent; without it they hold
    the names only.
    """
    raw = F.col("raw") if "raw" in issues.columns else None

    def named(column: str, attribute: str, given: Column) -> Column:
        return F.when(given, F.to_variant_object(F.struct(F.col(column).alias(attribute))))

    def filled(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit("")) != ""

    fields = F.struct(
        "summary", "description",
        stored_format(F.col("created")).alias("created"),
        stored_format(F.col("updated")).alias("updated"),
        _object(raw, ["$.fields.status"], named("status", "name", filled("status")), True).alias("status"),
        _object(raw, ["$.fields.priority"], named("priority", "name", filled("priority")), True).alias("priority"),
        _object(raw, ["$.fields.assignee"], named("assignee", "displayName", F.col("has_assignee")), False)
        .alias("assignee"),
        _object(raw, ["$.fields.reporter"], named("reporter", "displayName", filled("reporter")), True)
        .alias("reporter"),
        _object(raw, ["$.fields.issuetype", "$.fields.issue_type"],
                named("issue_type", "name", filled("issue_type")), True).alias("issue_type"),
        _object(raw, ["$.fields.resolution"], named("resolution", "name", F.col("has_resolution")), False)
        .alias("resolution"),
        stored_format(F.col("resolutiondate")).alias("resolutiondate"),
        F.lit(None).cast("string").alias("comments"))

    def comment(c: Column, author: Column) -> Column:
        return F.struct(
            c["id"].alias("id"), author.alias("author"), c["body"].alias("body"),
            stored_format(c["created"]).alias("created"), stored_format(c["updated"]).alias("updated"))

    if raw is None:
        comments = F.transform("comments", lambda c: comment(
            c, F.to_variant_object(F.struct(c["author"].alias("displayName")))))
    else:
        items = F.coalesce(*[
            F.try_variant_get(raw, p, "array<variant>") for p in ("$.fields.comment.comments", "$.comments")])
        comments = F.zip_with("comments", F.coalesce(items, F.array().cast("array<variant>")), lambda c, item: comment(
            c, F.coalesce(F.try_variant_get(item, "$.author", "variant"), F.parse_json(F.lit("{}")))))
    return issues.select("key", "project", fields.alias("fields"), comments.alias("comments"))


def stored_json(issues: DataFrame) -> DataFrame:
    """``project, value``: stored shape as one JSON text per issue, nulls written out."""
    stored = to_stored(issues)
    return stored.select(
        "project",
        F.to_json(F.struct("key", "project", "fields", "comments"), {"ignoreNullFields": "false"}).alias("value"))


def _replacing(writer: DataFrameWriter) -> DataFrameWriter:
    """Overwrite the whole folder, whatever the session says about partitions."""
    return writer.mode("overwrite").option("partitionOverwriteMode", "static")


def write_raw(issues: DataFrame, path: str, batch: int, form: str = "parquet", writer: str = "job") -> None:
    """Add validated issues to the store, below ``writer=<w>/batch=<n>/project=<p>/``; the batch is replaced as a whole.

    ``form="parquet"`` keeps the typed table, ``"json"`` one stored document per line. The rebalance
    hint collects a project's rows into few files and lets adaptive execution split a hot project.
    """
    if form == "json":
        lines = stored_json(issues).hint("rebalance", "project").write
        _replacing(lines).partitionBy("project").text(batch_path(path, writer, batch))
        return
    columns = [f.name for f in ISSUE_COLUMNS]
    rows = issues.select(*columns).hint("rebalance", "project").write.option("compression", PARQUET_CODEC)
    _replacing(rows).partitionBy("project").parquet(batch_path(path, writer, batch))


def read_store(spark: SparkSession, path: str, form: str = "parquet", latest: bool = False,
               projects: list[str] | None = None, batch: tuple[str, int] | None = None) -> DataFrame:
    """Delivered issues; ``latest`` keeps the newest version of a key, of equal ones that of the highest batch.

    ``project``, ``writer`` and ``batch`` are partition columns, so filters on them skip folders. ``batch``, a writer
    and a number, reads that one folder and lists no other.
    """
    def chosen(rows: DataFrame) -> DataFrame:
        return rows.filter(F.col("project").isin(projects)) if projects else rows

    whole, path = path, path if batch is None else batch_path(path, *batch)
    if not path_exists(spark, path):
        issues = spark.createDataFrame([], STORE_SCHEMA)
    elif form == "json":
        lines = T.StructType([T.StructField(n, T.StringType()) for n in ("value", "writer", "batch", "project")])
        docs = spark.read.schema(lines).option("basePath", whole).text(path)
        docs = docs.filter(F.col("project").isin(projects)) if projects else docs
        parsed = parse_issue(docs.select("value", F.col("project").alias("path_project"),
                                         F.concat_ws("/", "writer", "batch").alias("source_path")), shape="stored")
        issues = parsed.select(*[f.name for f in ISSUE_COLUMNS], F.regexp_replace("source_path", "/[^/]*$", "").alias("writer"),
                               F.substring_index("source_path", "/", -1).cast("bigint").alias("batch"))
    elif latest and batch is None:
        return chosen(read_newest(spark, path, _ISSUES, lambda rows: dedupe_latest(chosen(rows))))
    else:
        issues = read_batches(spark, whole, _ISSUES, only=batch).select(*STORE_SCHEMA.fieldNames())
    return dedupe_latest(chosen(issues)) if latest else chosen(issues)


def compact_store(spark: SparkSession, path: str) -> int:
    """Merge the batches of a Parquet store: afterwards each key has one row, its newest, and ``read_store(latest=True)`` is a scan."""
    return merge_batches(spark, path, _ISSUES, dedupe_latest, order=("project",))


def write_corpus(corpus: DataFrame, path: str, compression: str | None = None) -> int:
    """JSON lines, UTF-8, null attributes absent. Returns the row count, taken during the write.

    A line states its texts several times over (description, tasks), so ``compression="gzip"`` leaves about a fifth.
    """
    seen = Observation("corpus")
    rows = corpus.observe(seen, F.count(F.lit(1)).alias("n"))
    rows.write.mode("overwrite").json(path, compression=compression or "none")
    return int(seen.get["n"])


def save_progress(progress: DataFrame, folder: str, batch: int, writer: str = "job") -> None:
    _replacing(progress.select("project", "last_update").write).parquet(batch_path(f"{folder}/progress", writer, batch))


def save_processed(keys: DataFrame, folder: str, batch: int, writer: str = "job") -> None:
    """Add marks to the ledger, by bucket of the key, with a Bloom filter of the keys in every file, as large as they need."""
    marks = keys.select("key", "processed_at", bucket_of("key").alias("bucket")).hint("rebalance", "bucket").write
    filtered = _replacing(marks).option("parquet.bloom.filter.enabled#key", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
    filtered.partitionBy("bucket").parquet(batch_path(f"{folder}/processed", writer, batch))


def compact_ledger(spark: SparkSession, folder: str) -> int:
    """Merge the ledger's batches: one mark per key, its latest."""
    def newest(marks: DataFrame) -> DataFrame:
        last = F.max_by(F.struct("writer", "batch"), F.struct("processed_at", "batch")).alias("of")
        return marks.groupBy("key").agg(F.max("processed_at").alias("processed_at"), last).select("key", "processed_at", "of.*")

    return merge_batches(spark, f"{folder}/processed", PROCESSED_SCHEMA, newest)


def commit_batch(spark: SparkSession, folder: str, batch: int, writer: str = "job", keys: int = 0) -> None:
    """Record that a batch is complete, whatever marker files the session's committer writes."""
    record = spark.createDataFrame([(keys,)], "keys long").coalesce(1).write
    _replacing(record).json(batch_path(f"{folder}/commits", writer, batch))
