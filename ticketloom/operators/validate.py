"""Validation rules of a raw issue, and what happens to the rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def kind_of(doc: Column, path: str) -> Column:
    """VARIANT type name at ``path``: null when missing, ``VOID`` for an explicit null."""
    return F.schema_of_variant(F.try_variant_get(doc, path, "variant"))


def is_kind(kind: Column, name: str) -> Column:
    """Test of a type name; missing counts as false."""
    return F.coalesce(kind.startswith(name), F.lit(False))


def object_or_missing(kind: Column) -> Column:
    return kind.isNull() | kind.startswith("OBJECT")


def bad_time(kind: Column, at: Column, required: bool) -> Column:
    """A time that is no text or did not parse; an optional one may be missing or null."""
    bad = ~is_kind(kind, "STRING") | at.isNull()
    return bad if required else (kind.isNotNull() & (kind != "VOID") & bad)


def violations() -> Column:
    """Codes of the rules a document breaks, in ``RULE_CODES`` order; empty for a valid one.

    Works on the ``_kind_*`` columns and times of ``sources.issues.extracted``: a missing attribute
    and an explicit null are different things here. ``no_project`` is a rule of the store stage
    only, see ``parse_errors``.
    """
    def kind(name: str) -> Column:
        return F.col(f"_kind_{name}")

    def required_object(name: str) -> Column:
        return ~object_or_missing(kind(name))

    def optional_object(name: str) -> Column:
        return ~(object_or_missing(kind(name)) | (kind(name) == "VOID"))

    in_fields = {
        "null_container": required_object("comment") | required_object("project"),
        "summary": ~is_kind(kind("summary"), "STRING"),
        "description": ~(kind("description").isNull() | kind("description").isin("VOID", "STRING")),
        "created": bad_time(kind("created"), F.col("created"), required=True),
        "updated": bad_time(kind("updated"), F.col("updated"), required=True),
        "resolutiondate": bad_time(kind("resolutiondate"), F.col("resolutiondate"), required=False),
        "status": required_object("status"),
        "priority": required_object("priority"),
        "reporter": required_object("reporter"),
        "issuetype": required_object("issuetype"),
        "assignee": optional_object("assignee"),
        "resolution": optional_object("resolution"),
        "comment": F.col("_comments_unlisted") | F.exists("comments", lambda c: c["bad"]),
    }
    has_fields = is_kind(kind("fields"), "OBJECT")
    homeless = F.col("_stated").isNull() & ~F.coalesce(F.col("key").contains("-"), F.lit(True))
    rules = [F.when(~is_kind(kind("key"), "STRING"), "missing_key"), F.when(~has_fields, "missing_fields")]
    rules += [F.when(has_fields & broken, code) for code, broken in in_fields.items()]
    rules.append(F.when(homeless, "no_project"))
    return F.when(F.col("raw").isNull(), F.array(F.lit("bad_json"))).otherwise(
        F.filter(F.array(*rules), lambda c: c.isNotNull()))


def parse_errors(codes: Column) -> Column:
    """The codes that also stop the transform step, which can name a project by its path."""
    return F.filter(codes, lambda c: c != "no_project")


def split_valid(parsed: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and the quarantine that keeps the codes with the raw text.

    ``strict`` fails the job at the first invalid row instead of skipping it.
    """
    invalid = F.size("violations") > 0
    if strict:
        message = F.concat(
            F.lit("invalid issue "), F.coalesce("key", F.lit("unknown")), F.lit(": "),
            F.array_join("violations", ","))
        # part of the codes column, so that the check runs wherever the rows are used
        checked = F.when(invalid, F.raise_error(message).cast("array<string>")).otherwise(F.col("violations"))
        parsed = parsed.withColumn("violations", checked)
    return parsed.filter(~invalid), parsed.filter(invalid)
