"""Raw issue documents: file scan, and JSON text -> typed issue rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.functions.fence import computed_once
from ticketloom.functions.names import (
    name_of, path_text, project_from_key, project_from_object_key, project_from_path,
)
from ticketloom.functions.times import parse_ts
from ticketloom.operators.validate import bad_time, is_kind, kind_of, object_or_missing, violations
from ticketloom.schema import COMMENT_TYPE, UNKNOWN_AUTHOR, UNKNOWN_PROJECT
from ticketloom.session import path_exists
from ticketloom.sources.lenient import last_name_wins, parse_document

DOCUMENT_SCHEMA = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("source_path", T.StringType()),
])


def read_raw(spark: SparkSession, path: str, projects: list[str] | None = None,
             layout: str = "files", store: str = "tree", glob: str = "*.json") -> DataFrame:
    """``value, source_path, path_project`` of every ``*.json`` file below ``path``.

    ``layout="files"`` is one document per file; ``layout="lines"`` is one document per line, the
    compacted form for large stores (a file per document overloads any file system at scale).
    ``store`` selects the project rule: directory ``tree`` or ``object`` keys. The project filter
    looks at the path only, so files of other projects are never parsed. No directory, no rows.
    """
    if not path_exists(spark, path):
        docs = spark.createDataFrame([], DOCUMENT_SCHEMA)
    else:
        docs = spark.read.text(
            path, wholetext=layout == "files", recursiveFileLookup=True, pathGlobFilter=glob,
        ).select("value", F.col("_metadata.file_path").alias("source_path"))
    return with_path_project(docs, path, store, projects)


def with_path_project(docs: DataFrame, root: str, store: str = "tree",
                      projects: list[str] | None = None) -> DataFrame:
    """Add ``path_project``; keep the listed projects (none listed keeps all).

    A file whose path tells nothing is named by its content. The first filter needs the path alone,
    so the scan leaves out files of other projects before it opens them.
    """
    last_name_wins(docs.sparkSession)
    where = path_text(F.col("source_path"))
    by_path = project_from_object_key(where) if store == "object" else project_from_path(where, root)
    if store == "object":
        named = by_path
    else:
        named = F.coalesce(by_path, _project_in_document(F.col("value")), F.lit(UNKNOWN_PROJECT))
    if projects:
        docs = docs.filter(by_path.isNull() | by_path.isin(projects))
    docs = docs.withColumn("path_project", named)
    return docs.filter(F.col("path_project").isin(projects)) if projects else docs


def _project_in_document(value: Column) -> Column:
    """Project as the document states it, for files whose name tells nothing."""
    doc = parse_document(value)
    named = F.coalesce(
        F.nullif(F.try_variant_get(doc, "$.project", "string"), F.lit("")),
        F.nullif(F.try_variant_get(doc, "$.fields.project.key", "string"), F.lit("")),
        project_from_key(F.try_variant_get(doc, "$.key", "string")))
    return F.when(doc.isNotNull(), F.coalesce(named, F.lit("")))


def _text(doc: Column, path: str) -> Column:
    return F.try_variant_get(doc, path, "string")


def _comment(c: Column, i: Column) -> Column:
    """Comment text attributes, with what the validator asks about them."""
    author, body = kind_of(c, "$.author"), kind_of(c, "$.body")
    unfit = (
        ~is_kind(F.schema_of_variant(c), "OBJECT") | ~object_or_missing(author)
        | (body.isNotNull() & (body != "STRING")))
    return F.struct(
        i.cast("int").alias("idx"),
        F.coalesce(_text(c, "$.id"), F.lit("")).alias("id"),
        F.coalesce(_text(c, "$.author.displayName"), F.lit(UNKNOWN_AUTHOR)).alias("author"),
        F.coalesce(_text(c, "$.body"), F.lit("")).alias("body"),
        _text(c, "$.created").alias("created"), _text(c, "$.updated").alias("updated"),
        kind_of(c, "$.created").alias("kind_created"), kind_of(c, "$.updated").alias("kind_updated"),
        unfit.alias("unfit"))


def _timed_comment(c: Column) -> Column:
    return F.struct(
        c["idx"].alias("idx"), c["id"].alias("id"), c["author"].alias("author"), c["body"].alias("body"),
        parse_ts(c["created"]).alias("created"), parse_ts(c["updated"]).alias("updated"),
        c["kind_created"].alias("kind_created"), c["kind_updated"].alias("kind_updated"), c["unfit"].alias("unfit"))


def _judged_comment(c: Column) -> Column:
    bad = (
        c["unfit"] | bad_time(c["kind_created"], c["created"], required=True)
        | bad_time(c["kind_updated"], c["updated"], required=False))
    return F.struct(*[c[f].alias(f) for f in COMMENT_TYPE.fieldNames()], bad.alias("bad"))


# attribute -> where each shape holds it
_TYPE = {"api": "$.fields.issuetype", "stored": "$.fields.issue_type"}
_COMMENTS = {"api": "$.fields.comment.comments", "stored": "$.comments"}
_KINDS = ["project", "comment", "summary", "description", "created", "updated", "resolutiondate", "status",
          "priority", "reporter", "assignee", "resolution"]


def extracted(parsed: DataFrame, shape: str, carried: list[str]) -> DataFrame:
    """Every attribute read from the VARIANT once, in three steps of plain columns: text and kinds,
    then times, then judged comments."""
    raw = F.col("raw")
    shapes = ["api", "stored"] if shape == "auto" else [shape]
    # the type attribute of the other shape counts only when the first one is missing
    types = [kind_of(raw, _TYPE[s]) for s in shapes]
    lists = [kind_of(raw, _COMMENTS[s]) for s in shapes]
    unlisted = F.lit(False)
    for kind in lists:
        unlisted = unlisted | F.coalesce(~kind.startswith("ARRAY"), F.lit(False))
    items = F.coalesce(*[F.try_variant_get(raw, _COMMENTS[s], "array<variant>") for s in shapes])
    stated = [_text(raw, "$.fields.project.key")] + ([] if shape == "api" else [_text(raw, "$.project")])
    texts = parsed.select(
        "raw", "value", *carried,
        kind_of(raw, "$.key").alias("_kind_key"), kind_of(raw, "$.fields").alias("_kind_fields"),
        *[kind_of(raw, f"$.fields.{a}").alias(f"_kind_{a}") for a in _KINDS],
        F.coalesce(*types).alias("_kind_issuetype"),
        unlisted.alias("_comments_unlisted"),
        F.transform(items, _comment).alias("comments"),
        F.coalesce(*[F.nullif(s, F.lit("")) for s in stated]).alias("_stated"),
        _text(raw, "$.key").alias("key"),
        *[_text(raw, f"$.fields.{a}").alias(a) for a in
          ("summary", "description", "created", "updated", "resolutiondate")],
        *[name_of(raw, f"$.fields.{a}").alias(a) for a in ("status", "priority", "resolution")],
        F.coalesce(*[_text(raw, f"{_TYPE[s]}.name") for s in shapes], F.lit("")).alias("issue_type"),
        *[name_of(raw, f"$.fields.{a}", "displayName").alias(a) for a in ("reporter", "assignee")])
    times = ("created", "updated", "resolutiondate")
    timed = texts.select(
        *[c for c in texts.columns if c not in (*times, "comments")],
        *[parse_ts(F.col(a)).alias(a) for a in times],
        F.transform("comments", _timed_comment).alias("comments"))
    none = F.array().cast(T.ArrayType(T.StructType(COMMENT_TYPE.fields + [T.StructField("bad", T.BooleanType())])))
    return timed.withColumn("comments", F.coalesce(F.transform("comments", _judged_comment), none))


def _nonempty(kind: Column) -> Column:
    """True for a non-empty object, the truth test of a dict."""
    return is_kind(kind, "OBJECT") & (kind != "OBJECT<>")


def parse_issue(docs: DataFrame, shape: str = "auto") -> DataFrame:
    """JSON ``value`` -> the typed columns of ``ISSUE_SCHEMA``, one row per input row.

    ``shape="auto"`` reads the tracker's shape and the stored shape, so that comments and type of
    stored files are kept; ``"api"`` looks at the tracker's places only; ``"stored"`` at the others.
    Types and missing-versus-null are judged on the VARIANT, before anything is cast. Repeated names and ``NaN``
    are read, see ``sources.lenient``.
    """
    last_name_wins(docs.sparkSession)
    carried = [c for c in ("source_path", "path_project") if c in docs.columns]
    parsed = computed_once(docs.select("value", *carried), raw=parse_document(F.col("value")))
    judged = computed_once(extracted(parsed, shape, carried), violations=violations())
    from_path = F.nullif(F.col("path_project"), F.lit("")) if "path_project" in carried else F.lit(None)
    return judged.select(
        "key",
        F.coalesce("_stated", project_from_key(F.col("key")), from_path).alias("project"),
        "summary", "description", "created", "updated", "resolutiondate", "status", "priority", "issue_type",
        "resolution",
        _nonempty(F.col("_kind_resolution")).alias("has_resolution"),
        _nonempty(F.col("_kind_assignee")).alias("has_assignee"),
        "reporter", "assignee",
        F.transform("comments", lambda c: F.struct(*[c[f].alias(f) for f in COMMENT_TYPE.fieldNames()]))
        .alias("comments"),
        "violations", *carried, "raw", "value")
