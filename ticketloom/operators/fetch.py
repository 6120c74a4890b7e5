"""Audits over tables of finished fetches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ticketloom.schema import (
    RETRY_BASE, RETRY_MAX_ATTEMPTS, RETRY_MAX_DELAY, RETRY_START_DELAY, RETRY_STATUS_CODES, SEARCH_PAGE_SIZE,
)
from ticketloom.session import written
from ticketloom.sources.pages import good_pages

_RUN = 10_000  # offsets made per inner sequence, so that no array grows with a project


def missing_pages(pages: DataFrame, max_issues: int | None = None, page: int = SEARCH_PAGE_SIZE) -> DataFrame:
    """Offsets below a project's total (or ``max_issues``) that no good page covers.

    Steps are of the largest page size that the project's good pages state, ``page`` where none does. A project
    without a good page misses offset 0, the only one that is known to exist.
    """
    good = good_pages(pages)
    seen = good.groupBy("project").agg(F.max("total").alias("total"), F.max("max_results").alias("step"))
    totals = pages.select("project").distinct().join(seen, "project", "left").select(
        "project", F.coalesce("total", F.lit(1)).alias("total"),
        F.when(F.col("step") > 0, F.col("step")).otherwise(page).alias("step"))
    if max_issues is not None:
        totals = totals.withColumn("total", F.least("total", F.lit(max_issues)))
    last = F.expr("(total - 1) div step")
    runs = totals.filter(F.col("total") > 0).select(
        "project", "step", last.alias("last"), F.explode(F.sequence(F.lit(0), F.expr(f"((total - 1) div step) div {_RUN}"))).alias("run"))
    expected = runs.select("project", "step", F.explode(F.sequence(
        F.col("run") * _RUN, F.least("last", F.col("run") * _RUN + F.lit(_RUN - 1)))).alias("n"))
    offsets = expected.select("project", (F.col("n") * F.col("step")).alias("start_at"))
    return offsets.join(good.select("project", "start_at").distinct(), ["project", "start_at"], "left_anti")


def missing_ranges(pages: DataFrame, max_issues: int | None = None) -> DataFrame:
    """``project, first, last``: runs of offsets below a project's total (or ``max_issues``) that no good page covers.

    A good page covers as many offsets as it states, so pages of different sizes may overlap or leave holes inside a
    page's step. Pages are laid out over ranges of project and offset: a gap is found between a page and the furthest
    end before it, inside its range or in an earlier one. A project without a good page misses offset 0, the only one
    that is known to exist.
    """
    good = good_pages(pages).where((F.col("start_at") >= 0) & (F.col("max_results") > 0)).select(
        "project", "start_at", (F.col("start_at") + F.col("max_results")).alias("end"), "total")
    every = pages.select("project").distinct()
    totals = every.join(good.groupBy("project").agg(F.max("total").alias("total")), "project", "left").select(
        "project", F.coalesce("total", F.lit(1)).alias("total"))
    if max_issues is not None:
        totals = totals.withColumn("total", F.least("total", F.lit(max_issues)))
    # the total is a page at which everything has to be covered up to
    marks = good.select("project", "start_at", "end").unionByName(
        totals.select("project", F.col("total").alias("start_at"), F.col("total").alias("end")))
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = written(marks.repartitionByRange(parts, "project", "start_at").withColumn("_part", F.spark_partition_id()), "pages")

    def before(*by: str, order: str):
        return W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, -1)

    earlier = placed.groupBy("project", "_part").agg(F.max("end").alias("_end")).select(
        "project", "_part", F.max("_end").over(before("project", order="_part")).alias("_earlier"))
    reached = placed.select("*", F.max("end").over(before("project", "_part", order="start_at")).alias("_inside")).join(
        earlier, ["project", "_part"]).join(totals, "project")
    first = F.greatest(F.coalesce("_inside", F.lit(0)), F.coalesce("_earlier", F.lit(0)))
    return reached.select("project", first.cast("long").alias("first"), (F.least("start_at", "total") - 1).cast("long").alias("last")).where("first <= last")


def retry_backlog(fetches: DataFrame) -> DataFrame:
    """Last fetch of each URL, when it failed in a retryable way: action and delay.

    ``attempt`` counts earlier retries; a null status is a network error. A numeric Retry-After of
    a 429 sets the delay, else it doubles from one second; both end at five minutes.
    """
    last = fetches.groupBy("url").agg(F.max_by(
        F.struct("project", "status", "attempt", "retry_after"), F.struct("ts", "attempt")).alias("last"))
    retryable = F.col("status").isNull() | F.col("status").isin(RETRY_STATUS_CODES)
    due = last.select("url", "last.*").filter(retryable)
    attempt = F.col("attempt") + 1
    asked = F.when(F.col("status") == 429, F.trim("retry_after").try_cast("double"))
    backoff = F.lit(RETRY_START_DELAY) * F.pow(F.lit(RETRY_BASE), attempt - 1)
    again = attempt <= RETRY_MAX_ATTEMPTS
    return due.select(
        "url", "project", "status", attempt.alias("attempt"),
        F.when(again, "retry").otherwise("give_up").alias("action"),
        F.when(again, F.least(F.coalesce(asked, backoff), F.lit(RETRY_MAX_DELAY))).alias("delay_seconds"))
