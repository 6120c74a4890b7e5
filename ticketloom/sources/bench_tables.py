"""Issues, comments, documents, pages and fetches derived from the benchmark tables.

The benchmark has no issue table, so one is joined together from ``documents`` (one issue per row),
``pages`` (HTML descriptions), ``events`` (times, types), ``labels`` (status) and ``conversations``
(comments). Everything is a join on the document number, so the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.functions.times import iso_format
from ticketloom.operators.comments import comment_counts, first_bodies, resolution_bodies
from ticketloom.operators.tasks import with_clean_description
from ticketloom.session import spread


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A benchmark table; its schema is read from the file once per process."""
    path = f"{folder}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _hours(n: Column) -> Column:
    return F.make_dt_interval(hours=n.cast("int"))


def issue_rows(spark: SparkSession, folder: str, parts: tuple[str, ...] = ("pages", "events", "labels")) -> DataFrame:
    """Typed issues without their comments, keyed by ``doc_id`` as well.

    ``parts`` names the tables to join; columns that need another one are left out.
    """
    issues = spread(table(spark, folder, "documents"), "doc_id", joined=bool(parts)).select(
        "doc_id", "text", F.upper("source").alias("project"))
    n = F.col("doc_id")
    columns = {
        "key": F.concat("project", F.lit("-"), n.cast("string")),
        "project": F.col("project"),
        "summary": F.when(n % 23 == 5, "").otherwise(F.coalesce("text", F.lit(""))),
        "priority": F.when(n % 5 == 0, "Blocker").when(n % 5 == 1, "Major").when(n % 5 == 2, "Minor")
        .when(n % 5 == 3, "Trivial").otherwise(""),
        "has_assignee": n % 3 != 0,
        "assignee": F.when((n % 3 == 0) | (n % 7 == 6), "")
        .otherwise(F.concat(F.lit("Dev "), (n % 11).cast("string"))),
    }
    if "pages" in parts:
        pages = table(spark, folder, "pages").select(F.col("page_id").alias("doc_id"), "html")
        issues = issues.join(pages, "doc_id", "left")
        columns["description"] = F.when(n % 17 != 0, F.coalesce("html", "text"))
    if "events" in parts:
        events = table(spark, folder, "events").select(
            F.col("event_id").alias("doc_id"), F.col("ts").alias("created"), "user_id", "event_type")
        issues = issues.join(events, "doc_id", "left")
        updated = F.col("created") + _hours(n % 72)
        columns |= {
            "created": F.col("created"),
            "updated": updated,
            "issue_type": F.when(F.col("event_type") == "error", "Bug").when(F.col("event_type") == "view", "Task")
            .otherwise(F.coalesce("event_type", F.lit(""))),
            "reporter": F.coalesce(F.concat(F.lit("User "), F.col("user_id").cast("string")), F.lit("")),
        }
    if "labels" in parts:
        labels = table(spark, folder, "labels").select("doc_id", "quality", "toxic")
        issues = issues.join(labels, "doc_id", "left")
        good, none = F.col("quality") == 1, F.col("quality").isNull()
        resolution = (
            F.when(good & (F.col("toxic") == 0), "Fixed").when(good & (F.col("toxic") == 1), "Won't Fix")
            .when(none & (n % 10 == 7), "Unresolved").when(none & (n % 10 == 9), ""))
        columns |= {
            "status": F.when(good & (F.col("toxic") == 0), "Resolved").when(good, "Closed")
            .when(F.col("quality") == 0, "Open").otherwise(""),
            "resolution": F.coalesce(resolution, F.lit("")),
            "has_resolution": resolution.isNotNull(),
        }
        if "events" in parts:
            columns["resolutiondate"] = F.when(resolution.isNotNull(), updated)
    return issues.select("doc_id", *[value.alias(name) for name, value in columns.items()])


def comment_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Comments keyed by ``doc_id``. ``created`` counts from 1970: it orders the comments of one
    issue, and ``dated_comment_rows`` moves it to the issue's time."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    suffix = F.when(F.col("turn") % 3 == 1, " Fixed by the <b>patch</b>.").otherwise("")
    return table(spark, folder, "conversations").select(
        F.col("conv_id").alias("doc_id"),
        F.col("turn").cast("int").alias("idx"),
        F.concat(F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string")).alias("id"),
        F.when(F.col("role") == "system", "Unknown").otherwise(F.col("role")).alias("author"),
        F.concat("text", suffix).alias("body"),
        (epoch + _hours(F.expr("turn div 6"))).alias("created"))


def dated_comment_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Comments of the issues, with issue key and time."""
    docs = table(spark, folder, "documents").select(
        "doc_id", F.concat(F.upper("source"), F.lit("-"), F.col("doc_id").cast("string")).alias("key"))
    events = table(spark, folder, "events").select(F.col("event_id").alias("doc_id"), "ts")
    at = F.col("ts") + F.expr("created - timestamp_ntz'1970-01-01 00:00:00'")
    # one join with the comments, so that adaptive execution may split a hot conversation
    return comment_rows(spark, folder).join(docs.join(events, "doc_id"), "doc_id").select(
        "key", "idx", "id", "author", "body", at.alias("created"))


def prepared_issues(spark: SparkSession, folder: str, first: bool = False, resolution: bool = False,
                    counts: bool = False, parts: tuple[str, ...] = ("pages", "events", "labels")) -> DataFrame:
    """Prepared issue table (see ``operators.tasks``) with the comment columns asked for."""
    issues = issue_rows(spark, folder, parts)
    if "description" in issues.columns:
        issues = with_clean_description(issues)
    comments = comment_rows(spark, folder)
    if first:
        issues = issues.join(first_bodies(comments, "doc_id"), "doc_id", "left")
    if resolution:
        issues = issues.join(resolution_bodies(comments, "doc_id"), "doc_id", "left")
    if counts:
        issues = issues.join(comment_counts(comments, "doc_id"), "doc_id", "left").withColumn(
            "n_comments", F.coalesce("n_comments", F.lit(0)))
    return issues


def issue_feed(spark: SparkSession, folder: str) -> DataFrame:
    """A feed of updates: the events, many per key."""
    return table(spark, folder, "events").select(
        F.concat(F.lit("SRC"), (F.col("user_id") % 20).cast("string"), F.lit("-"), F.col("user_id").cast("string"))
        .alias("key"),
        F.concat(F.lit("SRC"), (F.col("user_id") % 20).cast("string")).alias("project"),
        F.col("ts").alias("updated"),
        F.concat(F.lit("events/"), F.col("event_id").cast("string")).alias("source_path"),
        "event_id", "event_type")


def fetch_log(spark: SparkSession, folder: str) -> DataFrame:
    """One finished fetch per event."""
    n, user = F.col("event_id"), F.col("user_id")
    statuses = F.array(*[F.lit(s) for s in (200, 200, 200, 404, 429, 500, 503, 408)])
    url = F.when(n % 11 == 0, "https://tracker.example.org/rest/api/2/search").otherwise(F.concat(
        F.lit("https://tracker.example.org/rest/api/2/issue/SRC"), (user % 20).cast("string"), F.lit("-"),
        user.cast("string")))
    return table(spark, folder, "events").select(
        F.when(n % 3 == 0, F.concat(F.lit("SRC"), (n % 20).cast("string"))).alias("project"),
        url.alias("url"), F.get(statuses, (n % 8).cast("int")).alias("status"), (n % 7).cast("int").alias("attempt"),
        F.when(n % 5 == 0, "400").when(n % 5 == 1, "abc").when(n % 5 == 2, "30").alias("retry_after"), "ts")


def search_pages(spark: SparkSession, folder: str, mixed: bool = False) -> DataFrame:
    """Search responses: up to ten documents of a source per page of 200 document numbers.

    Every seventh page failed and every eleventh is cut off, by a number made of page and source. ``mixed`` pages state
    sizes of 10, 4 and 25 by turns.
    """
    docs = table(spark, folder, "documents").select(
        F.upper("source").alias("project"), F.expr("doc_id div 200").alias("page"), "doc_id")
    totals = docs.groupBy("project").agg(F.count(F.lit(1)).alias("total"))
    entry = F.struct(F.when(F.col("doc_id") % 29 != 0, F.concat(
        F.col("project"), F.lit("-"), F.col("doc_id").cast("string"))).alias("key"))
    # a page covers 200 document numbers, so its list has at most 200 entries
    pages = docs.groupBy("project", "page").agg(F.sort_array(F.collect_list(entry)).alias("issues"))
    number = F.col("page") * 20 + F.substring("project", 4, 9).cast("int")
    size = F.when(F.col("page") % 3 == 1, 4).when(F.col("page") % 3 == 2, 25).otherwise(10) if mixed else F.lit(10)
    body = F.to_json(F.struct("issues", "total", size.alias("maxResults")))
    return pages.join(totals, "project").select(
        "project", (F.col("page") * 10).alias("start_at"),
        F.when(number % 7 == 3, 500).otherwise(200).alias("status"),
        F.when(number % 11 == 5, F.left(body, F.length(body) - 1)).otherwise(body).alias("body"))


# --- raw documents ---


def _json_text(columns: list[str], df: DataFrame) -> DataFrame:
    """Replace string columns by their JSON text, in two steps so that no text is encoded twice."""
    encoded = df.select(*[c for c in df.columns if c not in columns],
                        *[F.to_json(F.array(c)).alias(c) for c in columns])
    return encoded.select(*[c for c in df.columns if c not in columns], *[
        F.when(F.col(c) != "[null]", F.substring(c, F.lit(2), F.length(c) - 2)).alias(c) for c in columns])


def _field(name: str, json: Column) -> Column:
    return F.concat(F.lit(f'"{name}":'), json)


def _api_time(at: Column) -> Column:
    return F.replace(iso_format(at), F.lit("+00:00"), F.lit("+0000"))


def raw_documents(spark: SparkSession, folder: str, broken: bool = False) -> DataFrame:
    """Issues as documents of the tracker's API: ``value, source_path, project, doc_id``.

    A document holds all its comments, so they are gathered per issue here and only here: that list
    is one output value. ``broken`` damages 24 of 31 documents, each in one way told by its number.
    """
    comments = comment_rows(spark, folder)
    author = F.when(F.col("author") == "Unknown", F.to_json(F.struct(F.lit("bot").alias("name")))).otherwise(
        F.to_json(F.struct(F.col("author").alias("name"), F.col("author").alias("displayName"))))
    comments = _json_text(["id", "body"], comments.select("doc_id", "idx", "id", author.alias("author"), "body", "created"))
    events = table(spark, folder, "events").select(F.col("event_id").alias("doc_id"), "ts")
    at = _api_time(F.col("ts") + (F.col("created") - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")))
    item = F.concat(
        F.lit('{"id":'), "id", F.lit(',"author":'), "author", F.lit(',"body":'), "body",
        F.lit(',"created":"'), at, F.lit('"}'))
    gathered = comments.join(events, "doc_id").groupBy("doc_id").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("idx", item.alias("item")))), lambda s: s["item"]), ",").alias("items"))
    issues = issue_rows(spark, folder)
    times = ["created", "updated", "resolutiondate"]
    issues = issues.select(*[c for c in issues.columns if c not in times], *[_api_time(F.col(t)).alias(t) for t in times])
    issues = _json_text(["key", "summary", "description", *times], issues).join(gathered, "doc_id", "left")
    n = F.col("doc_id") % 31 if broken else F.lit(0)

    def damaged(cases: dict[int, str | None], good: Column) -> Column:
        """``good``, or in the numbered cases another JSON text (None: attribute missing)."""
        out = good
        if not broken:
            return out
        for case, text in cases.items():
            out = F.when(n == case, F.lit(text)).otherwise(out)
        return out

    def named(column: str) -> Column:
        return F.when(F.col(column) != "", F.to_json(F.struct(F.col(column).alias("name"))))

    items = F.coalesce("items", F.lit(""))
    items = damaged({
        20: '{"id":"1","author":null,"body":"x","created":"2024-01-01T00:00:00.000+0000"}',
        21: '{"id":"1","author":{},"body":null,"created":"2024-01-01T00:00:00.000+0000"}',
        22: '{"id":"1","author":{},"body":"x","created":"never"}'}, items)
    project = F.to_json(F.struct(F.col("project").alias("key")))
    assignee = F.when(F.col("has_assignee"), F.to_json(F.struct(
        F.lit("dev").alias("name"), F.nullif("assignee", F.lit("")).alias("displayName"))))
    resolution = F.when(F.col("has_resolution"), F.to_json(F.struct(F.col("resolution").alias("name"))))
    fields = F.concat_ws(
        ",",
        _field("project", damaged({5: "null", 23: None}, project)),
        _field("summary", damaged({7: None, 8: "123", 9: "null", 24: "null"}, F.col("summary"))),
        _field("description", damaged({10: "5"}, F.coalesce("description", F.lit("null")))),
        _field("created", damaged({11: None}, F.col("created"))),
        _field("updated", damaged({12: '"yesterday"', 24: None}, F.col("updated"))),
        _field("resolutiondate", damaged({13: '"soon"'}, F.col("resolutiondate"))),
        _field("status", damaged({14: "null"}, named("status"))),
        _field("priority", damaged({15: "null"}, named("priority"))),
        _field("reporter", damaged({16: '"x"'}, F.to_json(F.struct(
            F.lit("user").alias("name"), F.nullif("reporter", F.lit("")).alias("displayName"))))),
        _field("issuetype", damaged({17: "null"}, named("issue_type"))),
        _field("assignee", damaged({18: '"bob"'}, F.coalesce(assignee, F.lit("null")))),
        _field("resolution", damaged({19: "7"}, F.coalesce(resolution, F.lit("null")))),
        _field("comment", damaged({6: "null"}, F.concat(F.lit('{"comments":['), items, F.lit("]}")))))
    key = damaged({2: None, 3: "77", 23: '"HOMELESS"'}, F.col("key"))
    value = F.concat(F.lit("{"), F.concat_ws(
        ",", _field("key", key), _field("fields", damaged({4: None}, F.concat(F.lit("{"), fields, F.lit("}"))))),
        F.lit("}"))
    whole = issues.select("doc_id", "project", value.alias("value"))
    if not broken:
        return whole.select("value", F.col("doc_id").cast("string").alias("source_path"), "project", "doc_id")
    return whole.select(
        F.when(n == 1, F.left("value", F.length("value") - 1)).otherwise(F.col("value")).alias("value"),
        F.col("doc_id").cast("string").alias("source_path"), "project", "doc_id")
