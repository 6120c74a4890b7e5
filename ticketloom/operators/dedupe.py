"""Duplicates and state lookups. No operator gathers all copies of a key in one task."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.functions.times import epoch_micros
from ticketloom.operators.select import ranked_by_range
from ticketloom.session import written


def _content_hash(df: DataFrame) -> Column:
    """Last tie-break, so that equal order values still give one fixed winner."""
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.VariantType)]
    return F.xxhash64(*plain)


def _one_per(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """First row per ``by``. Spark cuts ``row_number() = 1`` before the shuffle too, so each map
    task sends one row per key, however many copies it holds."""
    ranked = df.withColumn("_rn", F.row_number().over(W.partitionBy(*by).orderBy(*order)))
    return ranked.filter(F.col("_rn") == 1).drop("_rn")


def drop_processed(df: DataFrame, processed: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Rows whose key is not in the ledger. ``keys`` may give the keys of ``df`` where they come cheaper.

    The ledger outgrows every batch, so it is first reduced to the keys of the batch: with a small batch that is a
    filter over its scan, and the anti-join meets only keys that do repeat. ``load_processed`` leaves out the buckets
    without a key of the batch before that.
    """
    wanted = (df if keys is None else keys).select("key").distinct()
    return df.join(processed.select("key").join(wanted, "key", "left_semi"), "key", "left_anti")


def dedupe_first(df: DataFrame, order: tuple[str, ...] = ("updated", "source_path")) -> DataFrame:
    """First record per key wins."""
    known = [F.col(c) for c in order if c in df.columns]
    return _one_per(df, ["key"], known + [_content_hash(df)])


def dedupe_latest(df: DataFrame) -> DataFrame:
    """Latest ``updated`` per key wins; of equal ones the highest ``batch``, where the rows have one."""
    later = [F.col("batch").desc()] if "batch" in df.columns else []
    return _one_per(df, ["key"], [F.col("updated").desc(), *later, _content_hash(df)])


def upsert_latest(old: DataFrame, new: DataFrame) -> DataFrame:
    """Table with one row per key, brought up to date: latest ``updated`` wins, new wins a tie.

    ``old`` is read once.
    """
    batch = written(dedupe_latest(new), "upsert")  # used twice, and of known size
    rival = batch.select(F.col("key").alias("_key"), F.struct(*[F.col(c) for c in old.columns]).alias("_new"))
    # one row per key on either side: each old row meets its rival once, and the table is read once
    both = old.select(F.struct(*[F.col(c) for c in old.columns]).alias("_old")).join(
        rival, F.col("_old.key") == F.col("_key"), "full")
    newer = F.col("_old").isNull() | (F.col("_new.updated") >= F.col("_old.updated")) | F.col("_old.updated").isNull()
    won = F.when(F.col("_new").isNotNull() & F.coalesce(newer, F.lit(False)), F.col("_new")).otherwise(F.col("_old"))
    return both.select(won.alias("_row")).select("_row.*")


def append_processed(ledger: DataFrame, keys: DataFrame, cap: int | None = None) -> DataFrame:
    """Ledger with the keys added, latest mark per key; ``cap`` keeps the most recently marked, of equal marks the
    first keys. Rows are ranked over ranges, so that a large cap fills no single task."""
    merged = (
        ledger.select("key", "processed_at").unionByName(keys.select("key", "processed_at"))
        .groupBy("key").agg(F.max("processed_at").alias("processed_at")))
    if cap is None:
        return merged
    dated = merged.select(F.lit(0).alias("_all"), "key", "processed_at", (-epoch_micros(F.col("processed_at"))).alias("_age"))
    return ranked_by_range(dated, "_all", ("_age", "key"), "_rank").where(F.col("_rank") <= cap).select("key", "processed_at")


def dedupe_ttl(df: DataFrame, ttl: timedelta = timedelta(days=30), key: str = "key", at: str = "updated") -> DataFrame:
    """A row is a duplicate only within ``ttl`` after its key was last *kept*.

    Kept times form a chain: the next one is the first at or after last + ttl. One row per key and time takes part
    (``kept_times``). Of equal times one row stays; a row without a time is a duplicate only of others without.
    """
    micros = int(ttl.total_seconds() * 1_000_000)
    named = df.withColumn("_k", F.col(key)).withColumn("_t", epoch_micros(F.col(at)))
    # one row per key and time first: that cut happens before the shuffle, whatever a time holds
    order = [F.col(c) for c in ("source_path",) if c in df.columns] + [_content_hash(df)]
    single = _one_per(named, ["_k", "_t"], order)
    kept = kept_times(named.select("_k", "_t").where("_k is not null and _t is not null").distinct(), micros)
    same = F.col("_k").eqNullSafe(F.col("_key")) & F.col("_t").eqNullSafe(F.col("_kept"))
    timeless = named.where("_k is null or _t is null").select("_k", "_t").distinct()
    stays = kept.unionByName(timeless).select(F.col("_k").alias("_key"), F.col("_t").alias("_kept"))
    return single.join(stays, same, "left_semi").drop("_k", "_t")


def successors(times: DataFrame, micros: int) -> DataFrame:
    """Distinct ``_k, _t`` -> the same with ``to``, the key's first time at or after ``_t + micros``, and ``starts``.

    ``starts`` marks times without another less than ``micros`` before them. Times and due times are merged in one range-partitioned order of
    key and time. What lies in a later range is looked up in a list with one row per key and range it touches.
    """
    parts = int(times.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = times.select("_k", F.col("_t").alias("_at"), "_t", F.lit(False).alias("_due")).unionAll(
        times.select("_k", (F.col("_t") + F.lit(micros)).alias("_at"), "_t", F.lit(True).alias("_due")))
    # written once: the ranges must be the same in both uses
    merged = written(both.repartitionByRange(parts, "_k", "_at").withColumn("_part", F.spark_partition_id()), "ttl-merged")
    given = F.when(~F.col("_due"), F.col("_t"))
    touched = merged.groupBy("_k", "_part").agg(F.min(given).alias("_first"), F.max(given).alias("_last"))
    # what follows is asked in descending order: frames that grow cost one step per row, frames that shrink start anew

    def passed(*by: str, order: list) -> W:
        return W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)

    around = touched.select(
        "_k", "_part", F.min("_first").over(passed("_k", order=[F.desc("_part")])).alias("_later"),
        F.max("_last").over(passed("_k", order=["_part"])).alias("_earlier"))
    # a time at the very moment of a due time answers it, so it comes after it
    placed = merged.select(
        "*", F.min(given).over(passed("_k", "_part", order=[F.desc("_at"), "_due"])).alias("_next"),
        F.max(given).over(passed("_k", "_part", order=["_at", F.desc("_due")])).alias("_before")).join(around, ["_k", "_part"])
    before = F.coalesce("_before", "_earlier")
    found = placed.select(
        "_k", "_t", F.when(F.col("_due"), F.coalesce("_next", "_later")).alias("to"),
        F.when(~F.col("_due"), before.isNull() | (F.col("_t") - before >= micros)).alias("starts"))
    return found.groupBy("_k", "_t").agg(F.max("to").alias("to"), F.max("starts").alias("starts"))


def drop_marked(df: DataFrame, marks: DataFrame, ttl: timedelta = timedelta(days=30)) -> DataFrame:
    """Rows that are not within ``ttl`` of any mark of their key in the ledger, before or after it.

    So a row that is late by more than ``ttl`` counts as any other. The ledger is first reduced to the keys of the rows.
    Times are cut into spans of ``ttl``: a row meets the few marks of its own span and the two beside it, however many
    its key has.
    """
    micros = int(ttl.total_seconds() * 1_000_000)
    known = marks.select("key", "processed_at").join(df.select("key").distinct(), "key", "left_semi")
    near = known.select(F.col("key").alias("_key"), epoch_micros(F.col("processed_at")).alias("_mark")).withColumn(
        "_span", F.explode(F.sequence(F.floor(F.col("_mark") / micros) - 1, F.floor(F.col("_mark") / micros) + 1)))
    at = epoch_micros(F.col("updated"))
    same = (F.col("key") == F.col("_key")) & (F.floor(at / micros) == F.col("_span")) & (F.abs(at - F.col("_mark")) < micros)
    return df.join(near, same, "left_anti")


def kept_times(times: DataFrame, micros: int) -> DataFrame:
    """The times of each key that the time-to-live keeps, from its distinct times.

    Times are laid out over ranges of key and time. A key that fills no range lies in two neighbours at most, so it is
    walked in order of time by one task, which holds one row of it. The few keys that do fill one, at most one per
    two ranges, are followed by doubled pointers instead: no task sees a whole one of them.
    """
    parts = int(times.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = written(times.repartitionByRange(parts, "_k", "_t").withColumn("_part", F.spark_partition_id()), "ttl-times")
    large = written(placed.groupBy("_k").agg(F.min("_part").alias("a"), F.max("_part").alias("b")).where("b - a > 1").select("_k"), "ttl-large")
    walked = placed.join(large, "_k", "left_anti").select("_k", "_t").repartition("_k").sortWithinPartitions("_k", "_t").mapInArrow(
        _walking(micros), times.schema)
    if large.isEmpty():
        return walked
    return walked.unionAll(followed_times(placed.join(large, "_k", "left_semi").select("_k", "_t"), micros))


def _walking(micros: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by key and time -> those that are kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, due = None, 0
        for batch in batches:
            stays = np.zeros(batch.num_rows, bool)
            for row, (key, at) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                if key != last_key or at >= due:
                    stays[row], last_key, due = True, key, at + micros
            yield batch.filter(pa.array(stays))
    return run


def followed_times(times: DataFrame, micros: int) -> DataFrame:
    """The same by pointers, for keys of any size.

    Every time points to its successor. A time that comes ``micros`` or more after the one before it starts a chain of
    its own, as it is kept whatever came before. Each round reaches twice as far, so that the rounds grow with the
    logarithm of the longest chain.
    """
    linked = written(successors(times, micros), "ttl-links")
    starts = linked.where("starts").select("_k", "_t")
    # chains end where another one starts
    ends = starts.select("_k", F.col("_t").alias("to"))
    jumps = written(linked.where("to is not null").select("_k", "_t", "to").join(ends, ["_k", "to"], "left_anti"), "ttl-jumps")
    kept = starts
    while not jumps.isEmpty():
        kept = kept.unionAll(written(kept.join(jumps, ["_k", "_t"]).select("_k", F.col("to").alias("_t")), "ttl-kept"))
        further = jumps.select("_k", F.col("_t").alias("to"), F.col("to").alias("_to"))
        jumps = written(jumps.join(further, ["_k", "to"]).select("_k", "_t", F.col("_to").alias("to")), "ttl-jumps")
    return kept
