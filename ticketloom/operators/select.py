"""Filters, projections, lookups against progress, and the cap per project."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ticketloom.functions.text import clean_text
from ticketloom.functions.times import iso_format, utc_wall_clock, wall_clock
from ticketloom.schema import FALLBACK_DAYS, SEARCH_PAGE_SIZE
from ticketloom.session import written


def filter_projects(df: DataFrame, projects: list[str] | None, column: str = "project") -> DataFrame:
    """Keep the listed projects; none listed keeps all. Prunes partitions when ``column`` is one."""
    return df.filter(F.col(column).isin(projects)) if projects else df


def has_content(df: DataFrame) -> DataFrame:
    """Keep issues with a clean description or any comment, blank comments included.

    ``n_comments`` comes first: where it decides, the text is not looked at.
    """
    return df.filter((F.col("n_comments") > 0) | (F.col("desc_clean") != ""))


def start_of_day(at: Column) -> Column:
    return at.cast("timestamp_ntz").cast("date").cast("timestamp_ntz")


def updated_since(df: DataFrame, since: Column | datetime | None) -> DataFrame:
    """Keep ``updated >= since`` floored to its day; no ``since`` (None or null) keeps the row.

    A literal ``since`` reaches the Parquet scan; a column works after ``attach_progress``.
    """
    if since is None:
        return df
    if not isinstance(since, Column):
        return df.filter(F.col("updated") >= start_of_day(wall_clock(since)))
    return df.filter(since.isNull() | (F.col("updated") >= start_of_day(since)))


def order_by_updated(df: DataFrame) -> DataFrame:
    """Order of the incremental feed; the key settles ties."""
    return df.orderBy("updated", "key")


def resolve_since(projects: DataFrame, progress: DataFrame, start_date: Column | str | None = None,
                  now: Column | datetime | None = None) -> DataFrame:
    """``project, since``: the start date wins over the saved progress; a start date that is no
    ``YYYY-MM-DD`` means 30 days ago; neither means no bound (null)."""
    start = start_date if isinstance(start_date, Column) else F.lit(start_date).cast("string")
    if now is None:
        today = utc_wall_clock(F.current_timestamp())
    else:
        today = now if isinstance(now, Column) else wall_clock(now)
    given = F.when(
        start.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"),
        F.try_to_timestamp(start, F.lit("yyyy-M-d")).cast("date").cast("timestamp_ntz"))
    fallback = today - F.expr(f"INTERVAL '{FALLBACK_DAYS}' DAY")
    return (
        projects.withColumn("_start", F.nullif(start, F.lit("")))
        .join(progress.select("project", "last_update"), "project", "left")
        .select(
            "project",
            F.when(F.col("_start").isNotNull(), F.coalesce(given, fallback))
            .otherwise(F.col("last_update")).alias("since")))


def attach_progress(df: DataFrame, progress: DataFrame) -> DataFrame:
    """Add ``last_update`` of the row's project. No broadcast hint: the optimizer broadcasts the
    progress table when its size allows, and adaptive skew handling splits a hot project if not."""
    return df.join(progress.select("project", "last_update"), "project", "left")


def resume(df: DataFrame, progress: DataFrame) -> DataFrame:
    """Rows of the day of the last update and later, per project."""
    return updated_since(attach_progress(df, progress), F.col("last_update")).drop("last_update")


def metadata(df: DataFrame) -> Column:
    """The metadata object; ``assignee`` and ``resolution`` are null, so absent in JSON, when the
    issue has no such object."""
    return F.struct(
        F.col("key").alias("issue_key"), "project", F.col("summary").alias("title"),
        F.coalesce("status", F.lit("")).alias("status"),
        F.coalesce("priority", F.lit("")).alias("priority"),
        F.coalesce("reporter", F.lit("")).alias("reporter"),
        iso_format(F.col("created")).alias("created"), iso_format(F.col("updated")).alias("updated"),
        F.when(F.col("has_assignee"), F.coalesce("assignee", F.lit(""))).alias("assignee"),
        F.when(F.col("has_resolution"), F.coalesce("resolution", F.lit(""))).alias("resolution"))


def clean_comment_rows(comments: DataFrame) -> DataFrame:
    """Comment table -> ``author, body, created`` as they stand in the corpus, row by row."""
    kept = [c for c in comments.columns if c not in ("author", "body", "created")]
    return comments.select(
        *kept, "author", clean_text(F.col("body")).alias("body"), iso_format(F.col("created")).alias("created"))


def limit_per_project(df: DataFrame, cap: int, page: int = SEARCH_PAGE_SIZE, exact: bool = False,
                      order: tuple[str, ...] = ("updated", "key")) -> DataFrame:
    """Oldest ``cap`` rows per project, in column ``position``.

    The feed is cut page by page, so ``cap`` is rounded up to whole pages unless ``exact``.
    ``order`` must name a total order inside a project.
    """
    keep = cap if exact else -(-cap // page) * page
    group_limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if keep > group_limit:
        return ranked_by_range(df, "project", order, "position").filter(F.col("position") <= keep)
    # Two rounds of a small top-k: a hot project is first cut inside `salts` sub-groups, before and
    # after the shuffle, then over what is left of them (at most salts * keep rows).
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    first = W.partitionBy("project", "_salt").orderBy(*order)
    cut = salted.withColumn("_rn", F.row_number().over(first)).filter(F.col("_rn") <= keep)
    last = W.partitionBy("project").orderBy(*order)
    return (
        cut.drop("_rn", "_salt").withColumn("position", F.row_number().over(last))
        .filter(F.col("position") <= keep))


def ranked_by_range(df: DataFrame, group: str, order: tuple[str, ...], rank: str) -> DataFrame:
    """Exact row number per group for any group size: no task ever holds a whole group.

    Rows are range-partitioned by (group, order), which also splits a hot group; a rank is the
    number of the group's rows in earlier partitions plus the rank inside the partition. The placed
    rows are written once, because the partition numbers must not change between the two uses.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = written(
        df.repartitionByRange(parts, group, *order).withColumn("_part", F.spark_partition_id()), "rank")
    # one row per group and partition it touches: at most (groups + partitions) rows in all
    earlier = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = placed.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n")).select(
        group, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = W.partitionBy(group, "_part").orderBy(*order)
    return (
        placed.withColumn("_inside", F.row_number().over(inside))
        .join(offsets, [group, "_part"])
        .withColumn(rank, F.col("_before") + F.col("_inside"))
        .drop("_part", "_inside", "_before"))
