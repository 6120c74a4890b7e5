"""Raw issues -> corpus, as one lazy plan and one write."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ticketloom.operators.dedupe import dedupe_first
from ticketloom.operators.select import has_content
from ticketloom.operators.tasks import all_tasks, alpaca, clean_issues, with_comment_views
from ticketloom.operators.validate import parse_errors
from ticketloom.sinks.tables import read_store, write_corpus
from ticketloom.sources.issues import parse_issue, read_raw


def corpus_from_issues(issues: DataFrame, dedupe: bool = True, keep: tuple[str, ...] = (), form: str = "tasks",
                       keywords: list[str] | None = None) -> DataFrame:
    """Typed issues -> corpus rows: ``form="tasks"`` with metadata and derived tasks, ``"instructions"`` as instruction and
    response. ``keywords`` tell resolving comments. Cleaning runs before the duplicates are dropped: the shuffle then
    carries clean text only."""
    cleaned = clean_issues(issues, keywords)
    if dedupe:
        cleaned = dedupe_first(cleaned)
    prepared = has_content(with_comment_views(cleaned))
    return all_tasks(prepared, keep) if form == "tasks" else alpaca(prepared, keep=keep)


def read_issues(spark: SparkSession, path: str, projects: list[str] | None = None, layout: str = "files",
                store: str = "tree", shape: str = "auto", glob: str = "*.json", seen: Observation | None = None) -> DataFrame:
    """Issues of raw files that parse without error (``layout`` files or lines), or of the issue store.

    ``seen`` counts the documents (``documents``) and those that do not parse (``rejected``) while they are read.
    """
    if layout == "store":
        return read_store(spark, path, latest=True, projects=projects)
    parsed = parse_issue(read_raw(spark, path, projects, layout, store, glob), shape)
    parsed = parsed.withColumn("violations", parse_errors(F.col("violations")))
    if seen is not None:
        parsed = parsed.observe(seen, F.count(F.lit(1)).alias("documents"), F.count_if(F.size("violations") > 0).alias("rejected"))
    return parsed.filter(F.size("violations") == 0).drop("raw", "value", "violations")


class Built(NamedTuple):
    """What a corpus build wrote and what it left out; counts of documents are None where it read the issue store."""

    rows: int
    documents: int | None
    rejected: int | None


def build_corpus_counted(spark: SparkSession, path: str, output: str, projects: list[str] | None = None,
                         layout: str = "files", store: str = "tree", shape: str = "auto", dedupe: bool = True,
                         glob: str = "*.json", form: str = "tasks", keywords: list[str] | None = None,
                         compression: str | None = None) -> Built:
    """Build the corpus; the counts are taken on the way, in the one pass that writes it."""
    seen = Observation("documents") if layout != "store" else None
    issues = read_issues(spark, path, projects, layout, store, shape, glob, seen)
    rows = write_corpus(corpus_from_issues(issues, dedupe, form=form, keywords=keywords), output, compression)
    return Built(rows, *((seen.get["documents"], seen.get["rejected"]) if seen else (None, None)))


def build_corpus(spark: SparkSession, path: str, output: str, projects: list[str] | None = None,
                 layout: str = "files", store: str = "tree", shape: str = "auto", dedupe: bool = True,
                 glob: str = "*.json", form: str = "tasks", keywords: list[str] | None = None,
                 compression: str | None = None) -> int:
    """Build the corpus and return its row count. Unreadable documents are skipped."""
    return build_corpus_counted(spark, path, output, projects, layout, store, shape, dedupe, glob, form, keywords, compression).rows
