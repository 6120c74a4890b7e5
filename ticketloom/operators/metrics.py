"""Counts per label. Every aggregate combines before its shuffle, so hot labels stay small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.names import project_from_key, project_from_url
from ticketloom.schema import UNKNOWN_PROJECT


def corpus_count(corpus: DataFrame) -> DataFrame:
    return corpus.agg(F.count(F.lit(1)).alias("n_issues"))


def issues_by_project(issues: DataFrame) -> DataFrame:
    return issues.groupBy("project").agg(F.count(F.lit(1)).alias("n_issues"))


def requests_by_project_status(fetches: DataFrame) -> DataFrame:
    """Responses per project and status; the project of the row, else of its URL, else unknown."""
    named = F.coalesce(F.nullif("project", F.lit("")), project_from_url(F.col("url")), F.lit(UNKNOWN_PROJECT))
    return (
        fetches.filter(F.col("status").isNotNull())
        .groupBy(named.alias("project"), F.col("status").cast("string").alias("status"))
        .agg(F.count(F.lit(1)).alias("n_requests")))


def validation_errors(parsed: DataFrame) -> DataFrame:
    """Broken rules per project and code. A reject counts for the project it states, not for one
    guessed from its key."""
    stated = F.try_variant_get("raw", "$.fields.project.key", "string")
    return (
        parsed.select(F.coalesce(F.nullif(stated, F.lit("")), F.lit(UNKNOWN_PROJECT)).alias("project"),
                      F.explode("violations").alias("error_type"))
        .groupBy("project", "error_type").agg(F.count(F.lit(1)).alias("n_errors")))


def last_update_by_project(issues: DataFrame, progress: DataFrame | None = None) -> DataFrame:
    """High-water mark per project, never below the saved one; blank projects are left out."""
    seen = issues.select("project", F.col("updated").alias("last_update"))
    if progress is not None:
        seen = seen.unionByName(progress.select("project", "last_update"))
    return (
        seen.filter(F.trim(F.coalesce("project", F.lit(""))) != "")
        .groupBy("project").agg(F.max("last_update").alias("last_update")))


def raw_files_by_project(files: DataFrame) -> DataFrame:
    """Documents and distinct keys per project, plus the total in the row with a null project.

    Counting per (project, key) first leaves one row per key for the distinct count.
    """
    per_key = files.groupBy("project", "key").agg(F.count(F.lit(1)).alias("n"))
    return per_key.rollup("project").agg(
        F.sum("n").alias("n_files"), F.countDistinct("key").alias("n_keys"))


def project_of(issues: DataFrame) -> DataFrame:
    """Project column filled from the key where it is blank; rows without either are left out."""
    named = F.coalesce(F.nullif("project", F.lit("")), project_from_key(F.col("key")))
    return issues.withColumn("project", named).filter(F.col("project").isNotNull())
