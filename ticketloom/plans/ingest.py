"""Landing documents -> validated, de-duplicated issue store with state, batch by batch."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.functions.times import wall_clock
from ticketloom.operators.dedupe import dedupe_first, dedupe_latest, drop_processed
from ticketloom.operators.metrics import last_update_by_project
from ticketloom.operators.select import resume as resume_after
from ticketloom.operators.validate import split_valid
from ticketloom.session import PARQUET_CODEC, discard, scratch_path
from ticketloom.sinks.keyed import batch_path
from ticketloom.sinks.tables import commit_batch, read_store, save_processed, save_progress, write_raw
from ticketloom.sources.issues import parse_issue, read_raw
from ticketloom.sources.state import has_batch, load_processed, load_progress


def ingest_documents(docs: DataFrame, store: str, state: str, batch: int, mode: str = "first",
                     shape: str = "auto", strict: bool = False, form: str = "parquet",
                     processed_at: datetime | None = None, writer: str = "job", replace: bool = False, resume: bool = False) -> None:
    """Store one batch of raw documents under the next number of its writer.

    A number that was completed is refused unless ``replace`` says to run it again.

    ``resume`` leaves out rows from before the day up to which their project has been stored; a batch that is run again
    does not count its own progress.

    ``mode="first"`` never replaces a stored key; ``"latest"`` adds the newer version, and
    ``read_store(latest=True)`` picks it. Parsing happens once: the parsed batch is written to the
    shared folder, then rejects, issues and state are narrow reads of Parquet. That copy holds what they
    take: of a reject its text and codes, of an issue its columns, and its raw document where the store keeps
    documents. State is saved last, so a batch that stops half way is simply run again under its number.
    """
    spark = docs.sparkSession
    if not replace and has_batch(spark, state, writer, batch):
        raise ValueError(f"batch {batch} of writer {writer} is complete; take a new number, or replace=True")
    parsed = parse_issue(docs, shape)
    if strict:
        valid, _ = split_valid(parsed, strict=True)
        parsed = valid
    if form != "json":
        parsed = parsed.drop("raw")
    kept = [c for c in ("key", "project", "violations", "source_path", "value") if c in parsed.columns]
    rejected = F.size("violations") > 0
    parsed = parsed.select(*[c for c in kept if c != "value"], F.when(rejected, F.col("value")).alias("value"),
                           *[F.when(~rejected, F.col(c)).alias(c) for c in parsed.columns if c not in kept])
    scratch = scratch_path(spark, "parsed")
    parsed.write.option("compression", PARQUET_CODEC).parquet(scratch)
    staged = spark.read.schema(parsed.schema).parquet(scratch)
    valid, invalid = split_valid(staged)
    invalid.select(*kept).write.mode("overwrite").option("compression", PARQUET_CODEC).parquet(
        batch_path(f"{state}/quarantine", writer, batch))

    fresh = valid.drop("violations", "value", "path_project")
    if resume:
        fresh = resume_after(fresh, load_progress(spark, state, without=(writer, batch)))
    if mode == "first":
        # known rows go first, so that the wide sort of the rest is small
        fresh = dedupe_first(drop_processed(fresh, load_processed(spark, state, without=(writer, batch), keys=fresh)))
    else:
        fresh = dedupe_latest(fresh)
    write_raw(fresh, store, batch, form, writer)

    stored = read_store(spark, store, form, batch=(writer, batch))
    mark = wall_clock(processed_at or datetime.now(timezone.utc))
    save_progress(last_update_by_project(stored), state, batch, writer)
    save_processed(stored.select("key", mark.alias("processed_at")), state, batch, writer)
    commit_batch(spark, state, batch, writer)
    discard(spark, scratch)


def ingest(spark: SparkSession, landing: str, store: str, state: str, batch: int, layout: str = "files",
           projects: list[str] | None = None, glob: str = "*.json", **options: object) -> DataFrame:
    """``ingest_documents`` over a landing folder; returns what the batch stored."""
    ingest_documents(read_raw(spark, landing, projects, layout, glob=glob), store, state, batch, **options)
    form, writer = options.get("form", "parquet"), options.get("writer", "job")
    return read_store(spark, store, form, batch=(writer, batch))


def read_quarantine(spark: SparkSession, state: str) -> DataFrame:
    return spark.read.parquet(f"{state}/quarantine")
