"""The incremental form of the jobs: every stream stops when it has read what is there."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ticketloom.functions.times import epoch_micros
from ticketloom.operators.dedupe import dedupe_ttl, drop_marked
from ticketloom.operators.metrics import issues_by_project
from ticketloom.plans.corpus import corpus_from_issues
from ticketloom.plans.ingest import ingest_documents
from ticketloom.sinks.keyed import batch_path
from ticketloom.sinks.tables import read_store, save_processed, write_corpus
from ticketloom.sources.issues import with_path_project
from ticketloom.sources.state import load_processed


def stream_documents(spark: SparkSession, path: str, layout: str = "files",
                     max_files: int | None = None, glob: str = "*.json") -> DataFrame:
    """New ``*.json`` files below ``path`` as a stream of documents (see ``read_raw``)."""
    reader = (
        spark.readStream.format("text").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob).option("wholetext", str(layout == "files").lower())
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    docs = reader.load(path).select("value", F.col("_metadata.file_path").alias("source_path"))
    return with_path_project(docs, path)


def stream_writer(spark: SparkSession, checkpoint: str) -> str:
    """The writer that a checkpoint's batch numbers belong to: the id that Spark wrote into the checkpoint when it began.

    A checkpoint made anew under an old path is another writer; two spellings of one path are the same.
    """
    return "stream-" + json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).first()[0])["id"]


def run_available(df: DataFrame, checkpoint: str, each_batch: Callable[[DataFrame, int], None],
                  mode: str = "append") -> StreamingQuery:
    """Run a stream over what is available now and wait for it; the checkpoint remembers the rest."""
    query = (
        df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(each_batch).start())
    query.awaitTermination()
    return query


def append_by_batch(path: str, writer: str | None = None) -> Callable[[DataFrame, int], None]:
    """Sink with one folder per batch number, replaced when the batch is run again.

    Checkpoints that share ``path`` need a ``writer`` each, as each of them counts from 0.
    """
    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(batch_path(path, writer, batch) if writer else f"{path}/batch={batch}")
    return write


def stream_dedupe(issues: DataFrame, ttl: str = "30 days") -> DataFrame:
    """First record of a key within the time-to-live; the state forgets a key after it.

    Rows later than the watermark are dropped, and all rows of a key pass through its state task.
    For late rows or hot keys use ``stream_dedupe_ledger``.
    """
    # watermarks need a TIMESTAMP
    clock = F.timestamp_micros(epoch_micros(F.col("updated")))
    return issues.withColumn("_at", clock).withWatermark("_at", ttl).dropDuplicatesWithinWatermark(["key"]).drop("_at")


def stream_dedupe_ledger(issues: DataFrame, checkpoint: str, folder: str, ttl: timedelta = timedelta(days=30)
                         ) -> StreamingQuery:
    """The same rule with the ledger as state, and a hot key cut down before the shuffle.

    A row is dropped only if a kept row of its key lies within ``ttl`` of it, before or after; being late is no
    reason. Kept rows go to ``folder/kept``, their marks to the ledger in ``folder``, both by writer and batch.
    """
    def each(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        writer = stream_writer(spark, checkpoint)
        fresh = drop_marked(rows, load_processed(spark, folder, without=(writer, batch), keys=rows), ttl)
        append_by_batch(f"{folder}/kept", writer)(dedupe_ttl(fresh, ttl), batch)
        kept = spark.read.parquet(batch_path(f"{folder}/kept", writer, batch))
        save_processed(kept.select("key", F.col("updated").alias("processed_at")), folder, batch, writer)

    return run_available(issues, checkpoint, each)


class _KeepApart(StatefulProcessor):
    """Kept marks of a key, by spans of the time-to-live: two marks are never in one span, so a row looks at three."""

    def __init__(self, columns: list[str], micros: int, forget_ms: int | None):
        self.columns, self.micros, self.forget_ms = columns, micros, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.marks = handle.getMapState("marks", "span long", "mark long", ttlDurationMs=self.forget_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        known: dict[int, int | None] = {}

        def mark(span: int) -> int | None:
            if span not in known:
                known[span] = self.marks.getValue((span,))[0] if self.marks.containsKey((span,)) else None
            return known[span]

        frames = [f for f in rows if len(f)]
        if not frames:
            return
        frame = pd.concat(frames, ignore_index=True)
        frame.columns = [*self.columns, "_micros", "_tie"]  # names that are no identifiers do not come through
        frame = frame.sort_values(["_micros", "_tie"], kind="stable", ignore_index=True).drop_duplicates("_micros")
        kept = []
        for row, at in zip(frame.index, frame["_micros"].tolist(), strict=True):
            span = at // self.micros
            if all(m is None or abs(at - m) >= self.micros for m in (mark(span - 1), mark(span), mark(span + 1))):
                known[span] = at
                self.marks.updateValue((span,), (at,))
                kept.append(row)
        yield frame.loc[kept, self.columns]

    def close(self) -> None:
        pass


def stream_dedupe_state(issues: DataFrame, ttl: timedelta = timedelta(days=30), forget: timedelta | None = None) -> DataFrame:
    """The rule of ``stream_dedupe_ledger`` with the marks in Spark's own state store, one value per key and kept row.

    A row is dropped only if a kept row of its key lies within ``ttl`` of it, before or after, however late it comes; the
    rows of one micro-batch count in order of time. ``forget`` drops a mark so long (of the clock) after it was made.
    The state is arbitrary, so it needs the RocksDB provider: see ``with_rocksdb``. A micro-batch's rows of one key meet
    in one task, after equal times have been put together; rows without a key or time are left out.
    """
    plain = [f for f in issues.columns if not isinstance(issues.schema[f].dataType, T.VariantType)]
    rows = issues.where("key is not null and updated is not null").withColumn("_micros", epoch_micros(F.col("updated"))).withColumn(
        "_tie", F.xxhash64(*plain))
    forget_ms = None if forget is None else int(forget.total_seconds() * 1000)
    processor = _KeepApart(issues.columns, int(ttl.total_seconds() * 1_000_000), forget_ms)
    return rows.groupBy("key").transformWithStateInPandas(
        processor, issues.schema, "Append", "None" if forget is None else "ProcessingTime")


@contextmanager
def with_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams that start inside keep their state in RocksDB; the setting of the session comes back after."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stream_progress(issues: DataFrame, checkpoint: str, folder: str) -> StreamingQuery:
    """High-water mark per project over all batches; each batch writes the marks that moved."""
    marks = (
        issues.filter(F.trim(F.coalesce("project", F.lit(""))) != "")
        .groupBy("project").agg(F.max("updated").alias("last_update")))

    def each(rows: DataFrame, batch: int) -> None:
        append_by_batch(f"{folder}/progress", stream_writer(rows.sparkSession, checkpoint))(rows, batch)

    return run_available(marks, checkpoint, each, mode="update")


def progress_in_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``project, last_update`` as the state store of ``stream_progress`` holds them, read from its checkpoint."""
    state = spark.read.format("statestore").load(checkpoint)
    value = state.schema["value"].dataType.fieldNames()[0]
    return state.select(F.col("key.project").alias("project"), F.col("value")[value].alias("last_update"))


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Which stateful operators a checkpoint holds: name, state store, partitions, first and last batch."""
    return spark.read.format("state-metadata").load(checkpoint)


def batch_counters(issues: DataFrame, rejects: DataFrame) -> DataFrame:
    """Counters of one batch, one row per label: issues per project, and rejects per project and rule."""
    stored = issues_by_project(issues).select("project", F.lit("stored").alias("counter"), F.col("n_issues").alias("n"))
    refused = rejects.select("project", F.explode("violations").alias("counter")).groupBy("project", "counter").agg(F.count(F.lit(1)).alias("n"))
    return stored.unionByName(refused)


def read_counters(spark: SparkSession, state: str) -> DataFrame:
    """Counters of all batches that ``stream_corpus`` has finished, summed."""
    return spark.read.parquet(f"{state}/counters").groupBy("project", "counter").agg(F.sum("n").alias("n"))


def stream_corpus(spark: SparkSession, landing: str, checkpoint: str, store: str, state: str, corpus: str,
                  layout: str = "files", max_files: int | None = None, shape: str = "auto",
                  glob: str = "*.json", compression: str | None = None, **options: object) -> StreamingQuery:
    """Parse, validate, drop known keys, store, and append the batch's corpus lines.

    Each part of a batch is replaced as a whole under the batch number, so a replay after a failure
    leaves no duplicate and no gap. Numbers belong to the checkpoint: a new one, or a job on the same store,
    never writes over them. Counters of the batch go to ``state/counters``. ``compression`` is that of the corpus; ``options`` go to ``ingest_documents`` (``mode``, ``strict``, ``form``).
    """
    def each(docs: DataFrame, batch: int) -> None:
        writer = stream_writer(docs.sparkSession, checkpoint)
        ingest_documents(docs, store, state, batch, shape=shape, writer=writer, replace=True, **options)
        issues = read_store(docs.sparkSession, store, options.get("form", "parquet"), batch=(writer, batch))
        write_corpus(corpus_from_issues(issues, dedupe=False), batch_path(corpus, writer, batch), compression)
        rejects = docs.sparkSession.read.parquet(batch_path(f"{state}/quarantine", writer, batch))
        batch_counters(issues, rejects).write.mode("overwrite").parquet(batch_path(f"{state}/counters", writer, batch))

    return run_available(stream_documents(spark, landing, layout, max_files, glob), checkpoint, each)
