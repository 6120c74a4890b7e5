"""Spelling variants: words one edit apart, found by k-d trees over letter counts, and the form each one stands for.

The words of a length are dealt into cells by the upper part of a k-d tree, whose splits are fitted on a sample of
``SAMPLE`` words; every word is in one cell. A word is searched in the cells of its own length and the two lengths
beside it that one edit can reach; each cell has a tree of its own (``kdtree``). Only words, counts and, per cell
searched, one partial answer are shuffled: no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import table
from llm.kdtree import Cell, Node, build, counts_of, letters_of, reach
from ticketloom.session import written

SHORTEST, LEAST = 7, 2
#: A form occurs at least so many times as often.
TIMES = 10
#: One occurrence in so many is damaged.
DAMAGED = 31
#: Words of a cell on average, and of the sample that the splits between cells are fitted on.
CELL, SAMPLE = 16_384, 200_000
#: Words that are searched in one step.
STEP = 8_192

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = r"[a-zÀ-ÿ]+"


def damaged(doc_id: Column, run: Column) -> Column:
    """The run, without one letter where the checksum of document and run says so. A null id is no text."""
    check = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (check % F.char_length(run)).cast("int")
    return F.when(check % DAMAGED == 0, F.concat(F.left(run, at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def word_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` -> ``word, n``: words of ``SHORTEST`` letters or more that occur ``LEAST`` times or more."""
    lowered = docs.select("doc_id", F.translate("text", UPPER, LOWER).alias("text"))
    runs = lowered.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    words = runs.where(F.char_length("run") >= SHORTEST).select(damaged(F.col("doc_id"), F.col("run")).alias("word"))
    return words.where(F.char_length("word") >= SHORTEST).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST)


def top_trees(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> dict[int, tuple[Node, int]]:
    """Per length, the splits between its cells and their number. Their size is that of the word table over ``cell``."""
    lengths = {r["size"]: r["count"] for r in words.groupBy(F.char_length("word").alias("size")).count().collect()}
    total = max(1, sum(lengths.values()))
    some = [r["word"] for r in words.where(F.pmod(F.xxhash64("word"), F.lit(total)) < sample).select("word").collect()]
    trees = {}
    for size, n in lengths.items():
        own = sorted(w for w in some if len(w) == size)
        if n <= cell or not own:
            trees[size] = (Node(leaf=0), 1)
            continue
        root, leaves = build(counts_of(letters_of(own)), max(1, cell * len(own) // n))
        trees[size] = (root, len(leaves))
    return trees


def _dealing(trees: dict[int, tuple[Node, int]]):
    """Words -> their own cell, and the cells in which an edit may lead to."""
    first, at = {}, 0
    for size in sorted(trees):
        first[size], at = at, at + trees[size][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            for size, group in frame.groupby(frame["word"].str.len()):
                words, counts = group["word"].tolist(), counts_of(letters_of(group["word"].tolist()))
                ways = [(size, 0, 0, False), (size, 1, 1, True), (size + 1, 0, 1, True), (size - 1, 1, 0, True)]
                for other, take, add, asks in ways:
                    if other not in trees:
                        continue
                    for leaf, rows in reach(trees[other][0], counts, take, add):
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(len(rows), first[other] + leaf, np.int32)), pa.array(np.full(len(rows), asks)),
                            pa.array([words[i] for i in rows], pa.string()), pa.array(group["n"].to_numpy()[rows])], ["cell", "asks", "word", "n"])
    return run


_ANSWER = "word string, n_near long, form string, form_n long"


def _searching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell, the cell's own words first and the best of them before the others: one answer per question with a hit."""
    number, own, counts, tree = None, [], [], None
    for batch in batches:
        frame = batch.to_pandas()
        for (cell, asks), group in frame.groupby(["cell", "asks"], sort=True):
            if cell != number:
                number, own, counts, tree = cell, [], [], None
            if not asks:
                own += group["word"].tolist()
                counts += group["n"].tolist()
                continue
            if not own:
                continue
            tree = tree or Cell(own)
            for _, some in group.groupby(group["word"].str.len()):
                for at in range(0, len(some), STEP):
                    words = some["word"].iloc[at:at + STEP].tolist()
                    found, best = tree.search(words)
                    hit = np.flatnonzero(found)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([words[i] for i in hit], pa.string()), pa.array(found[hit]),
                        pa.array([own[i] for i in best[hit]], pa.string()), pa.array([counts[i] for i in best[hit]], pa.int64())],
                        ["word", "n_near", "form", "form_n"])


def near_words(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """``word, n`` -> ``word, n_near, best, best_n`` for words with a word one edit away: how many, and the most frequent of them."""
    trees = top_trees(words, cell, sample)
    tasks = max(words.sparkSession.sparkContext.defaultParallelism, sum(k for _, k in trees.values()))
    dealt = words.mapInArrow(_dealing(trees), "cell int, asks boolean, word string, n long")
    sorted_ = dealt.repartition(tasks, "cell").sortWithinPartitions("cell", "asks", F.col("n").desc(), "word")
    answers = sorted_.mapInArrow(_searching, _ANSWER)
    return answers.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("n"), F.col("form"))).alias("b")).select(
        "word", "n_near", F.col("b.form").alias("best"), (-F.col("b.n")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, form`` -> ``word, root``: the end of the chain of forms, by doubling the steps.

    A form is at least ``TIMES`` as frequent as its word, so a chain has at most 18 steps.
    """
    jumps = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = jumps.join(jumps.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left")
        moved = written(further.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        jumps = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return jumps


def variants(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """``word, n`` -> ``word, form, root, n, n_near, form_n``."""
    near = near_words(words, cell, sample)
    known = written(words.join(near, "word", "left").withColumn("stands", F.col("best_n") >= TIMES * F.col("n")).select(
        "word", F.when(F.col("stands"), F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("stands"), F.col("best_n")).alias("form_n")), "variants")
    ends = roots(known.where("form is not null").select("word", "form"))
    return known.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its form and root. Null texts have no words."""
    return variants(written(word_counts(table(spark, sf_dir, "documents").select("doc_id", "text")), "words"))


ORACLE = """
WITH RECURSIVE bits(i, c, k) AS (
  SELECT i, CAST(i AS BIGINT), 0 FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[a-z\\x{00C0}-\\x{00FF}]+')) AS run FROM documents),
long AS (SELECT doc_id, run, count(*) AS k FROM runs WHERE length(run) >= 7 GROUP BY ALL),
checked AS (
  SELECT run, k, xor(list_reduce(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
      lambda x: CAST(ord(x) AS BIGINT)), lambda c, x: CASE WHEN x < 128 THEN xor(c >> 8, t[1 + (xor(c, x) & 255)])
      ELSE xor(xor(c >> 8, t[1 + (xor(c, 195) & 255)]) >> 8, t[1 + (xor(xor(c >> 8, t[1 + (xor(c, 195) & 255)]), x - 64) & 255)]) END,
    4294967295), 4294967295) AS h FROM long, crc),
words AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word,
    CAST(sum(k) AS BIGINT) AS n FROM checked GROUP BY 1 HAVING sum(k) >= 2 AND length(word) >= 7),
cut AS (SELECT word, n, i, left(word, i) || substring(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word AS word, b.word AS near, b.n AS m FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM words a JOIN cut b ON b.rest = a.word
  UNION SELECT b.word, a.word, a.n FROM words a JOIN cut b ON b.rest = a.word),
best AS (SELECT word, count(*) AS n_near, max(m) AS m, min(near) AS none FROM pairs GROUP BY 1),
first AS (SELECT p.word, min(p.near) AS near FROM pairs p JOIN best b ON b.word = p.word AND b.m = p.m GROUP BY 1),
forms AS (
  SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN near END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n
  FROM words w LEFT JOIN best USING (word) LEFT JOIN first USING (word)),
chain AS (SELECT word, word AS root, form AS next FROM forms
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.next)
SELECT f.word, f.form, c.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM forms f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""
