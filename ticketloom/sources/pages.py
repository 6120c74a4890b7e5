"""Search result pages of the tracker, kept as a table of responses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.schema import SEARCH_PAGE_SIZE


def good_pages(pages: DataFrame) -> DataFrame:
    """Pages with status 200 and a JSON body, with ``total`` and ``max_results`` read out."""
    doc = pages.filter(F.col("status") == 200).withColumn("doc", F.try_parse_json("body"))
    return doc.filter(F.col("doc").isNotNull()).select(
        "project", "start_at", "doc",
        F.coalesce(F.try_variant_get("doc", "$.total", "bigint"), F.lit(0)).alias("total"),
        F.coalesce(F.try_variant_get("doc", "$.maxResults", "bigint"), F.lit(SEARCH_PAGE_SIZE))
        .alias("max_results"))


def parse_search_pages(pages: DataFrame) -> DataFrame:
    """``project, start_at, status, body`` -> one row per issue key found.

    Failed or unreadable pages and entries without a key are left out.
    """
    entries = F.try_variant_get("doc", "$.issues", "array<variant>")
    return (
        good_pages(pages)
        .select("project", "start_at", "total", "max_results", F.posexplode(entries).alias("position", "entry"))
        .select(
            "project", F.try_variant_get("entry", "$.key", "string").alias("key"),
            "position", "start_at", "total", "max_results")
        .filter(F.coalesce(F.col("key"), F.lit("")) != ""))
