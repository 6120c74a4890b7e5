"""Progress per project, the ledger of processed keys, and the record of finished batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.schema import PROCESSED_SCHEMA, PROGRESS_SCHEMA
from ticketloom.session import path_exists
from ticketloom.sinks.keyed import BUCKETS, batch_path, buckets_of, read_batches, read_live, read_manifest


def has_batch(spark: SparkSession, folder: str, writer: str, batch: int) -> bool:
    """Was this batch completed? Its record is written last; a record without its row does not count."""
    path = batch_path(f"{folder}/commits", writer, batch)
    return path_exists(spark, path) and not spark.read.schema("keys long").json(path).isEmpty()


def load_progress(spark: SparkSession, folder: str, without: tuple[str, int] | None = None) -> DataFrame:
    """Latest saved mark per project, of all batches but one. A damaged file fails the read."""
    rows = read_batches(spark, f"{folder}/progress", PROGRESS_SCHEMA, without={without[0]: [without[1]]} if without else None)
    return rows.groupBy("project").agg(F.max("last_update").alias("last_update"))


def load_processed(spark: SparkSession, folder: str, without: tuple[str, int] | None = None,
                   keys: DataFrame | None = None) -> DataFrame:
    """The ledger of all writers: ``key, processed_at``. A damaged file fails the read, as skipping it would store its keys again.

    A repeated batch passes its own writer and number, so that it does not see its own keys. ``keys`` are those that
    will be looked up: only their buckets are opened, whatever the ledger holds.
    """
    root = f"{folder}/processed"
    buckets = list(range(BUCKETS)) if keys is None else buckets_of(keys)
    manifest = read_manifest(spark, root)
    rows = read_batches(spark, root, PROCESSED_SCHEMA, without=manifest.merged, buckets=buckets).unionByName(
        read_live(spark, root, PROCESSED_SCHEMA, manifest, buckets))
    if without is not None:
        rows = rows.where((F.col("writer") != without[0]) | (F.col("batch") != without[1]))
    return rows.select(*PROCESSED_SCHEMA.fieldNames())
