"""Training-text builders. Input is a prepared issue table:

``key, project, summary, status, priority, issue_type, resolution, has_resolution, desc_clean,
has_description, first_bodies, resolution_bodies, n_comments`` - see ``prepare`` and the table
form in ``operators.comments``. Every text is cleaned before this module sees it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.fence import computed_once
from ticketloom.functions.text import (
    clean_text, clean_texts, labelled, nonblank, strip_ends, truncate,
)
from ticketloom.operators.comments import (
    clean_bodies, cleaned_comments, comment_objects, newest_resolution_bodies,
)
from ticketloom.operators.select import metadata
from ticketloom.schema import (
    ANSWER_COMMENTS, ANSWER_LIMIT, INPUT_LIMIT, NO_RESOLUTION_COMMENTS, NO_RESOLUTION_DETAILS,
    NO_RESOLUTION_INFO, RESPONSE_COMMENTS, SUMMARY_COMMENTS, UNCLASSIFIED,
)


def with_clean_description(df: DataFrame) -> DataFrame:
    """``description`` -> ``desc_clean`` and ``has_description`` (raw text not blank)."""
    return df.select(
        *[c for c in df.columns if c != "description"],
        clean_text(F.col("description")).alias("desc_clean"),
        (F.coalesce("description", F.lit("")) != "").alias("has_description"))


def clean_issues(issues: DataFrame, keywords: list[str] | None = None) -> DataFrame:
    """Typed issues with their texts cleaned, each exactly once: ``description`` becomes
    ``desc_clean`` and ``has_description``, ``comments`` holds clean bodies."""
    kept = [c for c in issues.columns if c not in ("description", "comments")]
    cleaned = computed_once(
        issues.withColumnRenamed("comments", "_comments"),
        desc_clean=clean_text(F.col("description")), comments=cleaned_comments(F.col("_comments"), keywords))
    return cleaned.select(
        *kept, "desc_clean", (F.coalesce("description", F.lit("")) != "").alias("has_description"), "comments")


def prepare(issues: DataFrame, keywords: list[str] | None = None) -> DataFrame:
    """Typed issues with a comment array -> prepared issues."""
    return with_comment_views(clean_issues(issues, keywords))


def with_comment_views(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(
        "*",
        F.size("comments").alias("n_comments"),
        clean_bodies(F.slice("comments", 1, SUMMARY_COMMENTS)).alias("first_bodies"),
        newest_resolution_bodies(F.col("comments")).alias("resolution_bodies"))


def _col(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _title_or_key() -> Column:
    return F.coalesce(nonblank(F.col("summary")), F.concat(F.lit("Issue "), F.col("key")))


def _bodies(name: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast("array<string>"))


def instruction() -> Column:
    labels = F.concat_ws(
        " | ", labelled("Status", F.col("status")), labelled("Type", F.col("issue_type")),
        labelled("Priority", F.col("priority")))
    described = F.when(F.col("has_description"), F.concat(F.lit("Description: "), F.col("desc_clean")))
    text = F.concat_ws("\n\n", labelled("Title", F.col("summary")), described, nonblank(labels))
    return F.coalesce(nonblank(text), F.concat(F.lit("Issue: "), F.col("key")))


def response(comments: Column | None = None) -> Column:
    """Answer text; ``comments`` is an array of raw bodies to use instead of the chosen ones."""
    if comments is None:
        bodies = _bodies("resolution_bodies")
    else:
        bodies = F.coalesce(clean_texts(F.slice(comments, 1, RESPONSE_COMMENTS)), _bodies("resolution_bodies"))
    name = _col("resolution")
    known = F.col("has_resolution") & (name != "") & (F.lower(name) != "unresolved")
    chosen = F.filter(F.slice(bodies, 1, RESPONSE_COMMENTS), lambda b: b != "")
    return (
        F.when(F.size(bodies) == 0, F.when(known, F.concat(F.lit("Resolution: "), name)).otherwise(NO_RESOLUTION_INFO))
        .when(F.size(chosen) == 0, NO_RESOLUTION_COMMENTS)
        .otherwise(F.array_join(chosen, "\n\n---\n\n")))


def alpaca(df: DataFrame, instruction_text: Column | None = None, response_text: Column | None = None,
           keep: tuple[str, ...] = ()) -> DataFrame:
    """``instruction, response, input``; null values of an override fall back to the built text."""
    def chosen(override: Column | None, built: Column) -> Column:
        return built if override is None else F.coalesce(override, built)

    return df.select(
        *keep, chosen(instruction_text, instruction()).alias("instruction"),
        chosen(response_text, response()).alias("response"), F.lit("").alias("input"))


def summarization() -> Column:
    comments = F.array_join(F.slice(_bodies("first_bodies"), 1, SUMMARY_COMMENTS), "\n\n")
    text = F.concat(F.col("desc_clean"), F.lit("\n\nComments:\n"), comments)
    resolved = F.when(
        F.col("has_resolution") & (_col("resolution") != ""), F.concat(F.lit(" - Resolved: "), F.col("resolution")))
    return F.struct(
        F.lit("summarization").alias("task"),
        truncate(strip_ends(text), INPUT_LIMIT).alias("input"),
        F.concat(_title_or_key(), F.coalesce(resolved, F.lit(""))).alias("output"))


def classification() -> Column:
    text = F.concat(F.lit("Title: "), _col("summary"), F.lit("\n\nDescription: "), F.col("desc_clean"))
    labels = F.concat_ws(
        " | ", labelled("Type", F.col("issue_type")), labelled("Priority", F.col("priority")),
        labelled("Status", F.col("status")),
        F.when(F.col("has_resolution"), labelled("Resolution", F.col("resolution"))))
    return F.struct(
        F.lit("classification").alias("task"),
        truncate(strip_ends(text), INPUT_LIMIT).alias("input"),
        F.coalesce(nonblank(labels), F.lit(UNCLASSIFIED)).alias("output"))


def qa() -> Column:
    bodies = F.slice(_bodies("resolution_bodies"), 1, ANSWER_COMMENTS)
    context = F.concat_ws(
        "\n\n", F.concat(F.lit("Title: "), _title_or_key()), labelled("Description", F.col("desc_clean")))
    answer = (
        F.when(F.size(bodies) > 0, F.array_join(bodies, "\n\n"))
        .when(F.col("has_resolution"), F.concat(F.lit("The issue was resolved as: "), _col("resolution")))
        .otherwise(NO_RESOLUTION_DETAILS))
    return F.struct(
        F.lit("qa").alias("task"),
        F.concat(F.lit("What is the issue with '"), _title_or_key(), F.lit("' and how was it resolved?"))
        .alias("question"),
        truncate(context, INPUT_LIMIT).alias("context"),
        truncate(answer, ANSWER_LIMIT).alias("answer"))


def all_tasks(prepared: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Corpus rows: ``metadata, description, comments, tasks{summarization, classification, qa}``.

    ``comments`` is there when the prepared table carries the array.
    """
    comments = [comment_objects(F.col("comments")).alias("comments")] if "comments" in prepared.columns else []
    return prepared.select(
        *keep, metadata(prepared).alias("metadata"), F.col("desc_clean").alias("description"), *comments,
        F.struct(
            summarization().alias("summarization"), classification().alias("classification"),
            qa().alias("qa")).alias("tasks"))
