"""Quality rules whose cutoffs carry a guarantee.

A rule rejects a document when one of its statistics passes a cutoff. For each stratum (language)
and rule, labelled good documents are a holdout: walking from the most lenient cutoff to stricter
ones, a cutoff is certified while the exact binomial test rejects "this cutoff rejects more than
``risk / rules`` of the good documents" (the Clopper-Pearson upper bound lies below it). The walk
stops at the first cutoff that is not certified, so the cutoffs of one walk need no correction among
themselves (fixed-sequence testing); the walks of all strata and rules share ``delta`` by
Bonferroni. With probability 1 - ``delta`` no stratum's rules together reject more than ``risk`` of
its good documents. Among certified cutoffs the one with the best margin of bad over good
rejections is taken, the most lenient on ties; if none rejects anything bad, the rule stays off.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ticketloom.session import written

from llm.common import WORD, table

RISK, DELTA = 0.02, 0.05
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = "[#*$%&|<>]"
STATS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """Rejects when the statistic is above (or, with ``below``, below) the cutoff. Cutoffs run from lenient to strict."""

    name: str
    top: str
    bottom: str
    cutoffs: tuple[float, ...]
    below: bool = False

    def value(self) -> Column:
        """Null for a text without words: Spark may work this out before the base rule that rejects such a text."""
        return F.try_divide(F.col(self.top), F.col(self.bottom))


def _steps(first: float, last: float, n: int = 40) -> tuple[float, ...]:
    return tuple(round(x, 6) for x in np.geomspace(first, last, n).tolist())


RULES = (
    Rule("symbols_per_word", "n_symbols", "n_words", _steps(4, 0.01)),
    Rule("dup_line_share", "n_dup_lines", "n_lines", _steps(0.95, 0.02)),
    Rule("repeat_share", "n_repeat_words", "n_words", _steps(0.2, 0.002)),
    Rule("long_words", "word_chars", "n_words", _steps(40, 5)),
    Rule("short_words", "word_chars", "n_words", _steps(1.05, 4.5), below=True),
)


def text_stats(text: str | None) -> tuple[int, ...]:
    """The statistics of ``STATS`` over a whole text; null counts as a text without words."""
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    repeated = 0
    if n > WINDOW:
        windows = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
        seen = Counter(windows)
        if len(seen) < len(windows):
            end = 0
            for start, window in enumerate(windows):
                if seen[window] > 1:
                    repeated += start + WINDOW - max(start, end)
                    end = start + WINDOW
    return (n, sum(map(len, words)), sum(map(text.count, "#*$%&|<>")), len(lines), len(lines) - len(set(lines)), repeated)


@F.pandas_udf(StructType([StructField(name, LongType()) for name in STATS]))
def _stats(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_stats(t) for t in texts], columns=list(STATS))


def with_stats(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with the struct ``stats``; each text is worked on once."""
    return df.withColumn("stats", _stats.asNondeterministic()(text))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), exactly: the regularised incomplete beta function by its continued fraction."""
    if k >= n:
        return 1.0
    a, b, x = float(n - k), float(k + 1), 1.0 - p
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta(b, a, 1.0 - x)
    return _beta(a, b, x)


def _beta(a: float, b: float, x: float) -> float:
    """I_x(a, b) for x below its mean, by the modified Lentz method."""
    if x <= 0:
        return 0.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    c, d = 1.0, 1.0 / (1.0 - (a + b) * x / (a + 1) or tiny)
    out, m = d, 0
    while True:
        m += 1
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 / (1.0 + num * d or tiny)
            c = 1.0 + num / c or tiny
            out *= d * c
        if abs(d * c - 1.0) < 1e-14:
            return front * out


def upper_bound(k: int, n: int, delta: float) -> float:
    """Clopper-Pearson: the largest rate under which k or fewer of n still have probability ``delta``."""
    if k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if binomial_tail(k, n, mid) > delta else (low, mid)
    return high


def select_cutoff(rule: Rule, good: np.ndarray, bad: np.ndarray, risk: float, delta: float) -> tuple | None:
    """``good[i]``, ``bad[i]``: documents that cutoff i is the first of the walk to reject (the last place: none does)."""
    n, certified, best = int(good.sum()), 0, None
    for i, cutoff in enumerate(rule.cutoffs):
        k, hits = int(good[: i + 1].sum()), int(bad[: i + 1].sum())
        if n == 0 or binomial_tail(k, n, risk) > delta:
            break
        certified, margin = i + 1, hits - k
        if margin > (best[0] if best else 0):
            best = (margin, cutoff, k, hits)
    return best and (best[1], n, best[2], best[3], upper_bound(best[2], n, delta), certified)


def fit_cutoffs(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA,
                stats: DataFrame | None = None) -> DataFrame:
    """One row per stratum and rule that is on: cutoff, holdout size, rejections and bound; a written table.

    ``docs``: doc_id, text and the stratum column, or ``stats``, the same rows with their statistics.
    Labels count once per doc_id; a document that any label calls good is good. Rows with a null
    label, a null doc_id or a failed base rule do not calibrate. An unlabelled stratum has no rules.
    """
    spark = labels.sparkSession
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.max("quality").alias("quality"))
    if stats is None:
        # only the labelled texts are worked on here; the join carries them, not the whole corpus, into Python
        some = docs.select("doc_id", "text", F.col(f"`{stratum}`").alias("stratum")).join(marks, "doc_id")
        stats = with_stats(some, F.col("text")).select("quality", "stratum", "stats.*")
    else:
        stats = stats.join(marks, "doc_id").select("quality", "stratum", *STATS)
    held = stats.where(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    walks = F.array(*[F.struct(F.lit(r.name).alias("rule"), _first_rejecting(r).alias("first")) for r in RULES])
    counts = held.select("stratum", "quality", F.inline(walks)).groupBy("stratum", "rule", "first").agg(
        F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad"))
    counts = written(counts, "quality-counts")  # strata x rules x cutoffs rows
    tests = max(1, counts.select("stratum", "rule").distinct().count())
    by_name = {r.name: r for r in RULES}

    def choose(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        rule = by_name[key[1]]
        good, bad = np.zeros(len(rule.cutoffs) + 1, np.int64), np.zeros(len(rule.cutoffs) + 1, np.int64)
        good[group["first"]], bad[group["first"]] = group["good"], group["bad"]
        found = select_cutoff(rule, good, bad, risk / len(RULES), delta / tests)
        return pd.DataFrame([(*key, *found)] if found else [], columns=[
            "stratum", "rule", "cutoff", "n_good", "good_rejected", "bad_rejected", "bound", "certified"])

    kind = held.schema["stratum"].dataType.simpleString()
    return written(counts.groupBy("stratum", "rule").applyInPandas(choose, (
        f"stratum {kind}, rule string, cutoff double, n_good long, good_rejected long, bad_rejected long, "
        "bound double, certified int")), "quality-cutoffs")


def _first_rejecting(rule: Rule) -> Column:
    """Place of the first cutoff of the walk that rejects a row."""
    value, places = rule.value(), F.lit(len(rule.cutoffs))
    for i in reversed(range(len(rule.cutoffs))):
        hit = value < rule.cutoffs[i] if rule.below else value > rule.cutoffs[i]
        places = F.when(hit, F.lit(i)).otherwise(places)
    return places


def with_verdict(df: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``df`` (stratum and the statistics) with ``base_failed`` and ``kept``.

    The cutoffs are a file of a few numbers per stratum; Spark broadcasts it while it is small and
    joins it otherwise.
    """
    # a left anti-join per rule would do; one row per stratum needs one join
    sets = written(cutoffs.groupBy(F.col("stratum").alias("of")).agg(*[
        F.max(F.when(F.col("rule") == r.name, F.col("cutoff"))).alias(f"cut_{r.name}") for r in RULES]), "quality-sets")
    rejected = F.lit(False)
    for r in RULES:
        cut = F.col(f"cut_{r.name}")
        rejected = rejected | F.coalesce(r.value() < cut if r.below else r.value() > cut, F.lit(False))
    out = df.join(sets, F.col("stratum").eqNullSafe(F.col("of")), "left")
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & ~rejected).drop(
        "of", *[f"cut_{r.name}" for r in RULES])


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, base rule and verdict of every document, with cutoffs calibrated per language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("lang").alias("stratum"))
    stats = written(with_stats(docs, F.col("text")).select("doc_id", "stratum", "stats.*"), "quality-stats")
    cutoffs = fit_cutoffs(docs, table(spark, sf_dir, "labels"), stats=stats)
    return with_verdict(stats, cutoffs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the calibrated rules keep, with their columns unchanged.

    Null and empty texts have no words and fail the base rule; repeated rows are judged alike.
    """
    cutoffs = fit_cutoffs(docs, table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct("*").alias("row"))
    judged = with_verdict(
        with_stats(rows, F.col("row.text")).select("row", F.col("row.lang").alias("stratum"), "stats.*"), cutoffs)
    return judged.where("kept").select("row.*")
