"""Choosing comments: from the array inside an issue, or from a comment table.

Both forms give the same two columns: ``first_bodies`` (first n in source order) and
``resolution_bodies`` (newest k with a resolution keyword, source order on ties), cleaned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ticketloom.functions.text import clean_text, clean_texts, contains_resolution_keywords
from ticketloom.functions.times import iso_format
from ticketloom.schema import RESPONSE_COMMENTS, SUMMARY_COMMENTS


def resolution_comments(comments: Column, k: int | None = RESPONSE_COMMENTS,
                        keywords: list[str] | None = None) -> Column:
    """Comments of an array with a keyword, newest first, stable on ties, first ``k``."""
    matching = F.filter(comments, lambda c: contains_resolution_keywords(c["body"], keywords))
    keyed = F.transform(matching, lambda c: F.struct(
        c["created"].alias("created"), (-c["idx"]).alias("rank"), c.alias("comment")))
    newest = F.transform(F.sort_array(keyed, asc=False), lambda s: s["comment"])
    return newest if k is None else F.slice(newest, 1, k)


def cleaned_comments(comments: Column, keywords: list[str] | None = None) -> Column:
    """Comment array -> ``idx, author, created, body (clean), is_resolution`` elements.

    Every body is cleaned once; the keyword test reads the raw body.
    """
    bodies = clean_texts(F.transform(comments, lambda c: c["body"]))
    return F.zip_with(comments, bodies, lambda c, body: F.struct(
        c["idx"].alias("idx"), c["author"].alias("author"), c["created"].alias("created"),
        body.alias("body"), contains_resolution_keywords(c["body"], keywords).alias("is_resolution")))


def clean_bodies(comments: Column) -> Column:
    return F.transform(comments, lambda c: c["body"])


def newest_resolution_bodies(comments: Column, k: int = RESPONSE_COMMENTS) -> Column:
    """Clean bodies of the newest ``k`` resolution comments of a ``cleaned_comments`` array."""
    matching = F.filter(comments, lambda c: c["is_resolution"])
    keyed = F.transform(matching, lambda c: F.struct(
        c["created"].alias("created"), (-c["idx"]).alias("rank"), c["body"].alias("body")))
    return F.transform(F.slice(F.sort_array(keyed, asc=False), 1, k), lambda s: s["body"])


def comment_objects(comments: Column) -> Column:
    """Array elements as the corpus shows them: author, body, created."""
    return F.transform(comments, lambda c: F.struct(
        c["author"].alias("author"), c["body"].alias("body"), iso_format(c["created"]).alias("created")))


# --- the same choices over a comment table (one row per comment) ---


def _top(comments: DataFrame, by: str, order: list[Column], n: int, name: str) -> DataFrame:
    """First ``n`` clean bodies per ``by``.

    ``row_number() <= n`` is cut before the shuffle as well, so an issue with a third of all
    comments costs n rows per map task; only n rows per issue are gathered into the array.
    """
    picked = comments.withColumn("_rn", F.row_number().over(W.partitionBy(by).orderBy(*order)))
    cleaned = picked.filter(F.col("_rn") <= n).select(by, "_rn", clean_text(F.col("body")).alias("_body"))
    gathered = F.sort_array(F.collect_list(F.struct("_rn", "_body")))
    return cleaned.groupBy(by).agg(F.transform(gathered, lambda s: s["_body"]).alias(name))


def first_bodies(comments: DataFrame, by: str = "key", n: int = SUMMARY_COMMENTS) -> DataFrame:
    return _top(comments, by, [F.col("idx")], n, "first_bodies")


def resolution_rows(comments: DataFrame, by: str = "key", k: int = RESPONSE_COMMENTS,
                    keywords: list[str] | None = None) -> DataFrame:
    """Rows of the newest ``k`` resolution comments per issue, with their ``rank``."""
    matching = comments.filter(contains_resolution_keywords(F.col("body"), keywords))
    newest = W.partitionBy(by).orderBy(F.col("created").desc(), F.col("idx"))
    return matching.withColumn("rank", F.row_number().over(newest)).filter(F.col("rank") <= k)


def resolution_bodies(comments: DataFrame, by: str = "key", k: int = RESPONSE_COMMENTS,
                      keywords: list[str] | None = None) -> DataFrame:
    matching = comments.filter(contains_resolution_keywords(F.col("body"), keywords))
    return _top(matching, by, [F.col("created").desc(), F.col("idx")], k, "resolution_bodies")


def comment_counts(comments: DataFrame, by: str = "key") -> DataFrame:
    return comments.groupBy(by).agg(F.count(F.lit(1)).alias("n_comments"))
