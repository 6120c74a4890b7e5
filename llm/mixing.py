"""Mixing sources to target weights by weighted fair queueing.

Each source queues its documents in a hashed shuffle order, pass after pass. A queued copy's virtual
finish time is the tokens of its source up to and including it, divided by the source's target. All
queues are merged in order of finish time and cut where the total budget is spent. No step holds a
source: running sums are taken inside small ranges of the order and carried over by range totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from llm.common import n_words, row_key, table
from ticketloom.session import written

SHARE, MAX_PASSES, WEIGHTS = 1.5, 2, (3, 1, 2)
#: Rows that one range of an order holds on average.
RANGE_ROWS = 20_000
#: Paces of sources that are looked at for cutting the merged order into even ranges; results do not depend on it.
STEPS = 32


def shuffle_key(doc_id: Column, other: Column | None = None) -> Column:
    """Place of a document in its source's queue: 60 bits of a hash of the id, and so the same in every run.

    Rows without an id take their place by ``other``, so that many different ones are spread over the queue.
    """
    text = F.coalesce(doc_id.cast("string"), F.lit("null") if other is None else F.concat(F.lit("null:"), other.cast("string")))
    return F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), text)), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, share: float = SHARE, passes: int = MAX_PASSES,
                   weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, size`` -> ``source, source_size, target`` (a written table, one row per source).

    Sources are ranked by code point, null last, and take the weights in turn. A target stops at
    ``passes`` times the source's size; the excess goes to the others by weight until none is above.
    """
    spark = sizes.sparkSession
    per_source = written(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    # ranks from range totals, so that no task needs all sources however many there are
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = written(
        per_source.withColumn("_null", F.col("source").isNull()).repartitionByRange(parts, "_null", "source")
        .withColumn("_part", F.spark_partition_id()), "mix-places")
    inside = W.partitionBy("_part").orderBy("_null", "source")
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # over one row per partition
    starts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    ranked = written(placed.withColumn("_in", F.row_number().over(inside)).join(starts, "_part").select(
        "source", "source_size",
        F.element_at(F.array(*map(F.lit, weights)), ((F.col("_in") + F.col("_start") - 1) % len(weights) + 1).cast("int"))
        .alias("weight")), "mix-weights")
    cap = passes * F.col("source_size")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    budget, level, capped = share * total, None, -1
    while True:  # scalars only: a round per set of sources that reach their cap, a few in practice
        open_ = F.lit(True) if level is None else F.col("weight") * F.lit(level) <= cap
        used, free, n = ranked.agg(F.sum(F.when(~open_, cap)), F.sum(F.when(open_, F.col("weight"))), F.count_if(~open_)).first()
        if not free or n == capped:
            break
        capped, level = n, (budget - (used or 0)) / free
    fair = F.col("weight") * F.lit(level or 0.0)
    return ranked.select("source", "source_size", F.least(fair, cap.cast("double")).alias("target"))


def running_total(df: DataFrame, group: list[str], order: list[str], place: Column, ranges: int, name: str) -> DataFrame:
    """Exact running sum of ``size`` per group in ``order``, in column ``name``.

    ``place`` in [0, 1) grows with the order; a group is cut into ``ranges`` ranges of it, each summed
    by its own task, and the totals of earlier ranges (groups x ranges rows) are added.
    """
    cut = df.withColumn("_range", F.least(F.floor(place * ranges), F.lit(ranges - 1)).cast("long"))
    before = W.partitionBy(*group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    totals = cut.groupBy(*group, "_range").agg(F.sum("size").alias("_sum")).select(
        *[F.col(g).alias(f"_{g}") for g in group], F.col("_range").alias("_r"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = W.partitionBy(*group, "_range").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    same = F.col("_range") == F.col("_r")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    return cut.withColumn("_inside", F.sum("size").over(inside)).join(totals, same).withColumn(
        name, F.col("_inside") + F.col("_before")).drop("_range", "_r", "_inside", "_before", *[f"_{g}" for g in group])


def finish_shares(rows: DataFrame, passes: int) -> list[tuple[float, float]]:
    """The finish times at which a source ends a pass, in order, each with the share of all copies that finish before it.

    A source's copies finish at an even pace of ``source_size / target`` a pass, as its queue is shuffled, so the number of
    copies grows straight between two such times. At most ``STEPS`` of them are kept, evenly: they only decide where ranges are cut.
    """
    per = rows.where("size > 0 and target > 0").groupBy("source", "source_size", "target").agg(F.count(F.lit(1)).alias("n"))
    pace = per.select((F.col("source_size") / F.col("target")).alias("pace"), "n")
    ends = pace.groupBy("pace").agg(F.sum("n").alias("n")).select(
        F.round(F.col("pace"), 3).alias("pace"), "n").groupBy("pace").agg(F.sum("n").alias("n")).orderBy(F.desc("n")).limit(STEPS).collect()
    total = sum(r["n"] for r in ends) * passes
    times = sorted({p * r["pace"] for r in ends for p in range(1, passes + 1)} | {0.0})
    return [(t, sum(min(t / max(r["pace"], 1e-9), passes) * r["n"] for r in ends) / total) for t in times] if total else [(0.0, 0.0)]


def evenly(value: Column, steps: list[tuple[float, float]]) -> Column:
    """Place in [0, 1] of a value by the shares at ``steps``, straight between them; grows with the value."""
    out = F.lit(1.0)
    for (t0, s0), (t1, s1) in reversed(list(zip(steps, steps[1:]))):
        straight = F.lit(s0) + (value - F.lit(t0)) * F.lit((s1 - s0) / (t1 - t0))
        out = F.when(value < t1, F.least(straight, F.lit(s1))).otherwise(out)  # rounding must not pass the next step
    return out


def fair_queue(items: DataFrame, share: float = SHARE, passes: int = MAX_PASSES,
               weights: tuple[int, ...] = WEIGHTS, extra: str | None = None) -> DataFrame:
    """``item, doc_id, source, size`` (and a column to carry along) -> the same rows with ``source_size, target`` and ``copies``, how often the mix has them.

    ``item`` is a unique number; ``tie``, where there is one, tells rows without an id apart. A row of size 0 and a source whose target is 0 get no copies. Rows
    that share an id follow one another by size, then by ``item``; a null source is a source of its own.
    """
    items = written(items.withColumn("place", shuffle_key(
        F.col("doc_id"), F.concat_ws(":", "size", *[c for c in ("tie",) if c in items.columns]))), "mix-items")  # fixes the numbers
    spark = items.sparkSession
    targets = source_targets(items, share, passes, weights)
    n, budget = items.count(), targets.agg(F.sum("target")).first()[0] or 0.0
    ranges = max(1, n // RANGE_ROWS)
    key = ["place", "doc_id", "size", "item"]
    queued = running_total(items, ["source"], key, F.col("place") / F.lit(float(1 << 60)), ranges, "queued")
    t = targets.withColumnRenamed("source", "of")
    rows = queued.join(t, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rows = written(rows, "mix-queues")
    finish = (F.col("pass") * F.col("source_size") + F.col("queued")) / F.col("target")
    copies = rows.where("size > 0 and target > 0").withColumn(
        "pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1)))).withColumn("finish", finish)
    merged = running_total(
        copies.withColumn("all", F.lit(0)), ["all"], ["finish", "source", "pass", *key],
        evenly(F.col("finish"), finish_shares(rows, passes)), ranges * passes, "spent")
    counts = merged.where(F.col("spent") <= F.lit(budget)).groupBy("item").agg(F.count(F.lit(1)).alias("copies"))
    return rows.join(counts, "item", "left").select(
        "item", *([extra] if extra else []), "doc_id", "source", "size", "source_size", "target",
        F.coalesce("copies", F.lit(0)).alias("copies"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes; null texts have none. Repeated rows queue as rows of their own."""
    docs = table(spark, sf_dir, "documents").select(
        F.monotonically_increasing_id().alias("item"), "doc_id", "source", n_words(F.col("text")).alias("size"),
        F.when(F.col("doc_id").isNull(), F.xxhash64("text")).alias("tie"))
    return fair_queue(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus: each document as many times as the mix has copies of it, columns unchanged.

    Rows that are the same in every column are one row whose copies add up.
    """
    rows = docs.select(F.struct("*").alias("row"), row_key(docs).alias("key"))
    items = rows.select(
        F.monotonically_increasing_id().alias("item"), "key", F.col("key").alias("tie"), "row.doc_id", "row.source",
        n_words(F.col("row.text")).alias("size"))
    copies = fair_queue(items, extra="key").groupBy("key").agg(
        F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")).where("copies > 0")
    found = rows.join(copies, "key")
    once = found.where("rows = 1").unionAll(found.where("rows > 1").dropDuplicates(["key"]))
    return once.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


ORACLE = """
WITH docs AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS place
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight
  FROM docs GROUP BY source),
steps AS (  -- caps bind in the order of 2 * size / weight: the level at which the first k sources are capped
  SELECT *, sum(2 * source_size) OVER w - 2 * source_size AS used, (SELECT sum(weight) FROM sources)
    - (sum(weight) OVER w - weight) AS free, (SELECT sum(source_size) FROM sources) AS total
  FROM sources WINDOW w AS (ORDER BY 2 * source_size / weight, source ROWS UNBOUNDED PRECEDING)),
level AS (
  SELECT (1.5 * CAST(total AS DOUBLE) - CAST(used AS DOUBLE)) / CAST(free AS DOUBLE) AS x FROM steps
  WHERE weight * ((1.5 * CAST(total AS DOUBLE) - CAST(used AS DOUBLE)) / CAST(free AS DOUBLE)) <= 2 * source_size
  ORDER BY used LIMIT 1),
targets AS (SELECT source, source_size, least(weight * x, CAST(2 * source_size AS DOUBLE)) AS target FROM sources, level),
queued AS (
  SELECT d.*, source_size, target,
    sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) AS queued
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT *, CAST(pass * source_size + queued AS DOUBLE) / target AS finish
  FROM queued, (VALUES (0), (1)) p(pass) WHERE size > 0 AND target > 0),
merged AS (
  SELECT *, sum(size) OVER (
    ORDER BY finish, source, pass, place, doc_id, size ROWS UNBOUNDED PRECEDING) AS spent FROM copies),
counts AS (SELECT doc_id, place, size, count(*) AS n FROM merged
  WHERE spent <= (SELECT sum(target) FROM targets) GROUP BY ALL)
SELECT q.doc_id, q.size, q.source_size, q.target, CAST(coalesce(n, 0) * q.size AS BIGINT) AS taken
FROM queued q LEFT JOIN counts c ON q.doc_id = c.doc_id AND q.size = c.size
"""
