"""Fixed values and table schemas shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: these must equal the original data product's to give its results ---

RESOLUTION_KEYWORDS = ["fix", "patch", "cause", "pr", "pull request", "solution", "resolved"]

RETRY_STATUS_CODES = [500, 502, 503, 504, 522, 524, 408, 429]
RETRY_MAX_ATTEMPTS = 5
RETRY_START_DELAY = 1.0
RETRY_MAX_DELAY = 300.0
RETRY_BASE = 2.0

SEARCH_PAGE_SIZE = 50
INPUT_LIMIT = 2000
ANSWER_LIMIT = 1000
SUMMARY_COMMENTS = 5
RESPONSE_COMMENTS = 3
ANSWER_COMMENTS = 2
FALLBACK_DAYS = 30

NO_RESOLUTION_INFO = "No resolution information available."
NO_RESOLUTION_COMMENTS = "No resolution comments found."
NO_RESOLUTION_DETAILS = "The issue status and resolution details are not available."
UNCLASSIFIED = "Unclassified"
UNKNOWN_AUTHOR = "Unknown"
UNKNOWN_PROJECT = "unknown"

# --- rule codes of the validator, in reporting order ---

RULE_CODES = [
    "bad_json", "missing_key", "missing_fields", "null_container", "summary", "description",
    "created", "updated", "resolutiondate", "status", "priority", "reporter", "issuetype",
    "assignee", "resolution", "comment", "no_project",
]

# Every timestamp of the engine is a TIMESTAMP_NTZ holding UTC wall-clock time, so that no result
# depends on the time zone of the session.

COMMENT_TYPE = T.StructType([
    T.StructField("idx", T.IntegerType()),
    T.StructField("id", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("created", T.TimestampNTZType()),
    T.StructField("updated", T.TimestampNTZType()),
])

ISSUE_COLUMNS = [
    T.StructField("key", T.StringType()),
    T.StructField("project", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("created", T.TimestampNTZType()),
    T.StructField("updated", T.TimestampNTZType()),
    T.StructField("resolutiondate", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
    T.StructField("priority", T.StringType()),
    T.StructField("issue_type", T.StringType()),
    T.StructField("resolution", T.StringType()),
    T.StructField("has_resolution", T.BooleanType()),
    T.StructField("has_assignee", T.BooleanType()),
    T.StructField("reporter", T.StringType()),
    T.StructField("assignee", T.StringType()),
    T.StructField("comments", T.ArrayType(COMMENT_TYPE)),
]

ISSUE_SCHEMA = T.StructType(ISSUE_COLUMNS + [
    T.StructField("violations", T.ArrayType(T.StringType())),
    T.StructField("source_path", T.StringType()),
    T.StructField("raw", T.VariantType()),
])

PROGRESS_SCHEMA = T.StructType([
    T.StructField("project", T.StringType()),
    T.StructField("last_update", T.TimestampNTZType()),
])

PROCESSED_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("processed_at", T.TimestampNTZType()),
])
