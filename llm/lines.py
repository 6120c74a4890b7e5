"""Line dedup by overlapping three-line windows.

Every run of three consecutive lines is a window, known by 128 bits of its lines. The first place of a
window, by document id and position, covers nothing; at every later place its three lines are covered, and the
union of covered lines is removed. A later window that overlaps a first one also takes the lines they share: of many
equal lines in a row the first alone stays. Lines are split at \\n and compared exactly; lines without a word
are not part of any window and stay. Rows that repeat id and text are places of their own, ordered by a hash
of the row: one of them keeps its lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import table
from ticketloom.functions.fence import computed_once

WINDOW = 3
#: Equal rows that one task makes of one row.
AGAIN = 1_000


def _has_word(line: Column) -> Column:
    return F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]"))


def _null_flags(schema: T.StructType, at: Column | None = None) -> list[Column]:
    """Which columns, also inside structs, are null: Spark's hashes skip nulls."""
    flags = []
    for f in schema.fields:
        value = F.col(f"`{f.name}`") if at is None else at.getField(f.name)
        flags.append(value.isNull())
        if isinstance(f.dataType, T.StructType):
            flags += _null_flags(f.dataType, value)
    return flags


def _keyed(rows: DataFrame) -> DataFrame:
    """``k1, k2, doc_id, text, row``: a row is known by 128 bits of all its columns, and so the same however often it is read."""
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    nulls = F.array(*_null_flags(rows.schema))
    return rows.select(F.xxhash64(F.lit(1), nulls, row).alias("k1"), F.xxhash64(F.lit(2), nulls, row).alias("k2"),
                       "doc_id", "text", row.alias("row"))


def _worded(text: Column) -> Column:
    """Lines with a word, and their places."""
    return F.filter(F.transform(F.split(text, "\n"), lambda line, i: F.struct(
        line.alias("line"), i.cast("int").alias("at"))), lambda x: _has_word(x["line"]))


def covered_lines(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """``k1, k2, doc_id, text`` -> ``k1, k2, covered``: the places of lines to remove, for rows that have some.

    Only hashes and places are shuffled. A frequent window is summed up before the shuffle, and its
    later places meet the one first place in a join that Spark splits when it is skewed. Rows that are the same in every
    column count as one place here.
    """
    # places of lines with a word, then one window per run of `window` of them
    kept = computed_once(rows.where("text is not null"), lines=_worded(F.col("text"))).where(F.size("lines") >= window)
    ids = [F.xxhash64, lambda *c: F.xxhash64(F.lit("second"), *c)]

    def one(i: Column) -> Column:
        parts = [F.get("lines", i + k) for k in range(window)]
        return F.struct(*[h(*[p["line"] for p in parts]).alias(n) for h, n in zip(ids, ("h1", "h2"), strict=True)],
                        F.array(*[p["at"] for p in parts]).alias("at"))

    places = F.transform(F.sequence(F.lit(0), F.size("lines") - window), one)
    windows = kept.select("k1", "k2", "doc_id", F.inline(places))
    # null ids come last; the hash of the row settles repeated ids
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2", F.col("at")[0].alias("at"))
    first = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "h1", "h2", F.col("first.k1").alias("of1"), F.col("first.k2").alias("of2"), F.col("first.at").alias("from"))
    later = windows.select("k1", "k2", "h1", "h2", "at").join(first, ["h1", "h2"]).where(
        (F.col("k1") != F.col("of1")) | (F.col("k2") != F.col("of2")) | (F.col("at")[0] != F.col("from")))
    return later.groupBy("k1", "k2").agg(F.array_distinct(F.flatten(F.collect_set("at"))).alias("covered"))


def dedup_lines(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, text, ...`` -> the same with ``clean`` (null stays null), ``n_lines`` and ``n_removed``.

    Two lines that meet when those between them go are not compared again. Rows that are the same in every column are one
    row and a count until the end; the order in which ``rows`` comes does not matter, nor that a task runs again. More
    than ``AGAIN`` of them are dealt over tasks before they become rows again.
    """
    keyed = _keyed(rows)
    covered = covered_lines(keyed.select("k1", "k2", "doc_id", "text"), window)
    whole = keyed.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.first("row").alias("row")).join(covered, ["k1", "k2"], "left")
    # every window of a further equal row is a later one
    worded = _worded(F.col("row.text"))
    every = F.when(F.size(worded) >= window, F.transform(worded, lambda x: x["at"]))
    lists = F.when(F.col("n") == 1, F.array(F.struct(F.lit(1).cast("long").alias("times"), "covered"))).otherwise(F.array(
        F.struct((F.col("n") - 1).alias("times"), F.coalesce(every, "covered").alias("covered")),
        F.struct(F.lit(1).cast("long").alias("times"), "covered")))
    few = whole.where(F.col("n") <= AGAIN).select("row", F.inline(lists))
    many = whole.where(F.col("n") > AGAIN).select("row", F.inline(lists)).select("row", "covered", F.explode(F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("times") - 1, F.lit(AGAIN).cast("long")),
        lambda i: F.struct(i.alias("from"), F.least(F.lit(AGAIN).cast("long"), F.col("times") - i).alias("times")))).alias("part"))
    dealt = many.repartition("part.from", "row.doc_id").select("row", F.col("part.times").alias("times"), "covered")
    found = few.unionByName(dealt)
    out = computed_once(found, lines=F.split("row.text", "\n"))
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "covered")
    left = F.array_join(F.transform(places, lambda i: F.get("lines", i)), "\n")
    text = F.col("row.text")
    clean = out.select(
        "row", "times", F.when(F.col("covered").isNull(), text).otherwise(left).alias("clean"),
        F.coalesce(F.when(text.isNotNull(), F.size("lines")), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.when(F.col("covered").isNotNull(), F.size("covered")), F.lit(0)).cast("long").alias("n_removed"))
    return clean.select(
        *[F.col("row").getField(c).alias(c) for c in rows.columns], "clean", "n_lines", "n_removed",
        F.explode(F.array_repeat(F.lit(1), F.col("times").cast("int"))).alias("_time")).drop("_time")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its deduplicated text."""
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", F.col("clean").alias("text"), "n_lines", "n_removed")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated lines; ``n_chars`` follows the text, and a text that loses every line is empty."""
    rows = docs.select("doc_id", "text", F.struct("*").alias("row"))
    clean = dedup_lines(rows).select("row", "clean")
    new = clean.withColumn("row", F.col("row").withField("text", F.col("clean")).withField(
        "n_chars", F.when(F.col("clean").eqNullSafe(F.col("row.text")), F.col("row.n_chars")).otherwise(
            F.length("clean").cast("long"))))
    return new.select("row.*")


ORACLE = """
WITH lines AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS pos, unnest(string_split(text, chr(10))) AS line
  FROM documents),
worded AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k
  FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
windows AS (
  SELECT a.doc_id, a.pos, [a.pos, b.pos, c.pos] AS places, a.line AS l1, b.line AS l2, c.line AS l3
  FROM worded a JOIN worded b ON b.doc_id = a.doc_id AND b.k = a.k + 1
  JOIN worded c ON c.doc_id = a.doc_id AND c.k = a.k + 2),
later AS (SELECT doc_id, unnest(places) AS pos FROM (
  SELECT *, row_number() OVER (PARTITION BY l1, l2, l3 ORDER BY doc_id, pos) AS n FROM windows) WHERE n > 1),
covered AS (SELECT DISTINCT doc_id, pos FROM later),
clean AS (
  SELECT l.doc_id, count(*) AS n_lines, count(c.pos) AS n_removed,
    coalesce(string_agg(line, chr(10) ORDER BY l.pos) FILTER (c.pos IS NULL), '') AS text
  FROM lines l LEFT JOIN covered c ON c.doc_id = l.doc_id AND c.pos = l.pos GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE c.text END AS text,
  CAST(coalesce(c.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(c.n_removed, 0) AS BIGINT) AS n_removed
FROM documents d LEFT JOIN clean c ON c.doc_id = d.doc_id
"""
