"""The registered queries: one per operator, each over the whole benchmark tables.

Timestamps leave a query as ISO text and arrays as joined text, so that results compare by value.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.functions.names import project_from_key, project_from_url
from ticketloom.functions.text import clean_text, contains_resolution_keywords
from ticketloom.functions.times import iso_format, parse_ts, stored_format, wall_clock
from ticketloom.operators import dedupe, fetch, metrics, select, tasks
from ticketloom.operators.comments import resolution_rows
from ticketloom.operators.validate import split_valid
from ticketloom.plans.corpus import build_corpus, build_corpus_counted
from ticketloom.plans.ingest import ingest_documents, read_quarantine
from ticketloom.schema import ISSUE_SCHEMA
from ticketloom.session import scratch_path, spread
from ticketloom.sinks.tables import compact_ledger, compact_store, read_store, save_processed, save_progress, stored_json, write_raw
from ticketloom.sources import bench_tables as bench
from ticketloom.sources.issues import parse_issue, read_raw, with_path_project
from ticketloom.sources.pages import parse_search_pages
from ticketloom.sources.state import load_processed, load_progress
from ticketloom.streaming import jobs as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


# --- sources ---


#: How ``_landed`` lays out its files.
LANDED = {"layout": "lines", "glob": "*.txt.gz"}


def _landed(spark: SparkSession, folder: str, broken: bool = False) -> str:
    """The raw documents, written as packed lines below ``project=<p>/`` in the shared folder."""
    path = scratch_path(spark, "landing")
    docs = bench.raw_documents(spark, folder, broken).select("value", "project")
    docs.hint("rebalance", "project").write.partitionBy("project").text(path, compression="gzip")
    return path


@query("raw_scan")
def raw_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_raw(spark, _landed(spark, folder, broken=True), **LANDED)
    bad = F.try_parse_json("value").isNull().cast("int")
    return docs.groupBy(F.col("path_project").alias("project")).agg(
        F.count(F.lit(1)).alias("n_documents"), F.sum(bad).alias("n_unreadable"))


@query("project_from_path")
def project_from_path(spark: SparkSession, folder: str) -> DataFrame:
    docs = bench.table(spark, folder, "documents")
    project, n = F.upper("source"), F.col("doc_id")
    key = F.concat(project, F.lit("-"), n.cast("string"))
    path = (
        F.when(n % 5 == 0, F.concat(F.lit("file:/data/raw/"), project, F.lit("/"), key, F.lit(".json")))
        .when(n % 5 == 1, F.concat(F.lit("file:/data/raw/"), key, F.lit(".json")))
        .otherwise(F.concat(F.lit("file:/data/raw/x"), n.cast("string"), F.lit(".json"))))
    value = (
        F.when(n % 5 == 2, F.to_json(F.struct(project.alias("project"), F.col("text"))))
        .when(n % 5 == 3, F.to_json(F.struct(key.alias("key"), F.col("text")))).otherwise("{broken"))
    named = with_path_project(docs.select("doc_id", path.alias("source_path"), value.alias("value")), "file:/data/raw")
    return named.select("doc_id", F.col("path_project").alias("project"))


def _parsed(spark: SparkSession, folder: str, broken: bool = False) -> DataFrame:
    return parse_issue(bench.raw_documents(spark, folder, broken))


def _doc_id() -> Column:
    return F.col("source_path").cast("bigint").alias("doc_id")


@query("parse_issue")
def parse_issue_documents(spark: SparkSession, folder: str) -> DataFrame:
    return _parsed(spark, folder).select(
        "key", "project", "summary", F.length("description").alias("description_chars"),
        iso_format(F.col("created")).alias("created"), iso_format(F.col("updated")).alias("updated"),
        iso_format(F.col("resolutiondate")).alias("resolutiondate"), "status", "priority", "issue_type",
        "resolution", "has_resolution", "has_assignee", "reporter", "assignee",
        F.size("comments").alias("n_comments"),
        F.array_join(F.transform("comments", lambda c: F.concat(
            c["author"], F.lit("@"), iso_format(c["created"]))), ";").alias("comment_heads"))


@query("parse_loose")
def parse_loose_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with repeated names at every depth and with ``NaN``, of which the last name counts; some are cut off."""
    docs, n = bench.raw_documents(spark, folder), F.col("doc_id")
    value = F.col("value")
    twice = F.replace(F.replace(F.replace(
        value, F.lit('"status":{'), F.lit('"status":{"name":"old",')), F.lit('"body":'), F.lit('"body":"old","body":')),
        F.lit('"fields":{'), F.lit('"fields":{"summary":7,"labels":NaN,'))
    loose = (
        F.when(n % 6 == 1, F.concat(F.lit('{"key":"OLD-0",'), F.substr(value, F.lit(2)))).when(n % 6 == 2, twice)
        .when(n % 6 == 3, F.replace(value, F.lit('"summary":'), F.lit('"summary":NaN,"votes":')))
        .when(n % 6 == 4, F.concat(F.lit('{"score":-Infinity,'), F.substr(twice, F.lit(2)), F.lit("\n")))
        .when(n % 6 == 5, F.concat(twice, F.lit("}"))).otherwise(value))
    issues = parse_issue(docs.withColumn("value", loose))
    return issues.select(
        _doc_id(), "key", "summary", "status", F.size("comments").alias("n_comments"),
        F.md5(F.array_join(F.transform("comments", lambda c: c["body"]), "|")).alias("bodies_md5"),
        F.array_join("violations", ",").alias("codes"))


@query("object_keys")
def object_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Project of an object's key: its second component, where it has one."""
    n, project = F.col("doc_id"), F.upper("source")
    name = F.concat(project, F.lit("-"), n.cast("string"), F.lit(".json"))
    uri = (
        F.when(n % 4 == 0, F.concat(F.lit("s3a://bucket/raw/"), project, F.lit("/"), name))
        .when(n % 4 == 1, F.concat(F.lit("gs://b/raw/"), project, F.lit("/more/"), name))
        .when(n % 4 == 2, F.concat(F.lit("s3a://bucket/raw/"), name)).otherwise(F.concat(F.lit("s3a://bucket/"), name)))
    docs = bench.table(spark, folder, "documents").select("doc_id", uri.alias("source_path"), F.lit("{}").alias("value"))
    return with_path_project(docs, "s3a://bucket", "object").select("doc_id", F.col("path_project").alias("project"))


@query("search_page_keys")
def search_page_keys(spark: SparkSession, folder: str) -> DataFrame:
    return parse_search_pages(bench.search_pages(spark, folder)).select(
        "project", "key", "start_at", "total", "max_results")


# --- sinks ---


@query("raw_roundtrip")
def raw_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    store = scratch_path(spark, "store")
    issues = _parsed(spark, folder)
    write_raw(issues, store, batch=0, form="json")
    return read_store(spark, store, form="json").select(
        "key", "project", "summary", F.length("description").alias("description_chars"),
        iso_format(F.col("updated")).alias("updated"), "status", "issue_type", "resolution", "has_resolution",
        "assignee", F.size("comments").alias("n_comments"))


@query("store_latest")
def store_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Three deliveries that overlap, the first two merged; then all three merged."""
    store, n = scratch_path(spark, "store"), F.col("doc_id")
    issues = bench.issue_rows(spark, folder).withColumn("comments", F.array().cast(ISSUE_SCHEMA["comments"].dataType))

    def version(rows: DataFrame, name: str, later: Column) -> DataFrame:
        return rows.withColumn("summary", F.concat("summary", F.lit(name))).withColumn("updated", F.col("updated") + F.make_dt_interval(later))

    def newest() -> DataFrame:
        return read_store(spark, store, latest=True).select("key", "summary", iso_format(F.col("updated")).alias("updated"), "batch")

    write_raw(issues.filter(n % 3 < 2), store, batch=0)
    write_raw(version(issues.filter(n % 3 > 0), " (2)", F.lit(1)), store, batch=1)
    compact_store(spark, store)
    # versions that come late, and versions that repeat the time of the newest one
    again = issues.filter((n % 5) < 2)
    write_raw(version(again, " (3)", F.when(n % 5 == 0, -1).when(n % 3 > 0, 1).otherwise(0)), store, batch=2)
    pending = newest().withColumn("state", F.lit("pending"))
    compact_store(spark, store)
    return pending.unionByName(newest().withColumn("state", F.lit("merged")))


@query("state_roundtrip")
def state_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Progress and ledger of two batches, the first one merged, as they are loaded again."""
    at, feed = scratch_path(spark, "state"), bench.issue_feed(spark, folder)
    middle = wall_clock(datetime(2024, 1, 16))
    for batch, part in enumerate((feed.filter(F.col("updated") < middle), feed.filter(F.col("updated") >= middle))):
        save_progress(metrics.last_update_by_project(part), at, batch)
        save_processed(part.select("key", F.col("updated").alias("processed_at")), at, batch)
        if batch == 0:
            compact_ledger(spark, at)
    marks = load_processed(spark, at).groupBy("key").agg(F.max("processed_at").alias("at"))
    return load_progress(spark, at).select(F.lit("progress").alias("kind"), F.col("project").alias("name"), iso_format(F.col("last_update")).alias("at")).unionByName(
        marks.select(F.lit("processed").alias("kind"), F.col("key").alias("name"), iso_format(F.col("at")).alias("at")))


@query("corpus_alpaca_roundtrip")
def corpus_alpaca_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    out = scratch_path(spark, "instructions")
    build_corpus(spark, _landed(spark, folder), out, **LANDED, form="instructions", compression="gzip")
    line = F.parse_json("value")
    return spark.read.text(out).select(*[F.variant_get(line, f"$.{n}", "string").alias(n) for n in ("instruction", "response", "input")])


@query("corpus_rejects")
def corpus_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """What a build over damaged documents writes and what it counts as unreadable; issues without a project are written."""
    out = scratch_path(spark, "corpus")
    built = build_corpus_counted(spark, _landed(spark, folder, broken=True), out, **LANDED, dedupe=False)
    return spark.read.text(out).agg(F.count(F.lit(1)).alias("n_lines")).select(
        "n_lines", F.lit(built.rows).cast("long").alias("n_rows"), F.lit(built.documents).cast("long").alias("n_documents"),
        F.lit(built.rejected).cast("long").alias("n_rejected"))


@query("corpus_jsonl_roundtrip")
def corpus_jsonl_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    out = scratch_path(spark, "corpus")
    build_corpus(spark, _landed(spark, folder), out, **LANDED, compression="gzip")
    lines = spark.read.text(out).select(F.parse_json("value").alias("line"))

    def text(path: str) -> Column:
        return F.variant_get("line", path, "string")

    return lines.select(
        text("$.metadata.issue_key").alias("issue_key"), text("$.metadata.project").alias("project"),
        text("$.metadata.title").alias("title"), text("$.metadata.assignee").alias("assignee"),
        text("$.metadata.resolution").alias("resolution"), text("$.description").alias("description"),
        F.size(F.variant_get("line", "$.comments", "array<variant>")).alias("n_comments"),
        text("$.tasks.summarization.input").alias("summarization_input"),
        text("$.tasks.classification.output").alias("classification_output"),
        text("$.tasks.qa.answer").alias("qa_answer"))


@query("stored_shape")
def stored_shape(spark: SparkSession, folder: str) -> DataFrame:
    doc = stored_json(_parsed(spark, folder)).select(F.parse_json("value").alias("doc"))

    def text(path: str) -> Column:
        return F.variant_get("doc", path, "string")

    return doc.select(
        text("$.key").alias("key"), text("$.project").alias("project"), text("$.fields.summary").alias("summary"),
        text("$.fields.created").alias("created"), text("$.fields.status.name").alias("status"),
        text("$.fields.issue_type.name").alias("issue_type"),
        text("$.fields.assignee.displayName").alias("assignee"),
        F.is_variant_null(F.variant_get("doc", "$.fields.comments", "variant")).alias("comments_null"),
        text("$.comments[0].author.displayName").alias("first_author"),
        text("$.comments[0].created").alias("first_created"))


# --- filters and projections ---


@query("filter_projects")
def filter_projects(spark: SparkSession, folder: str) -> DataFrame:
    return select.filter_projects(bench.issue_rows(spark, folder, ("labels",)), ["SRC1", "SRC7", "SRC13"]).select(
        "key", "project", "status", "priority")


@query("has_content")
def has_content(spark: SparkSession, folder: str) -> DataFrame:
    prepared = bench.prepared_issues(spark, folder, counts=True, parts=("pages",))
    return select.has_content(prepared).select("key", "n_comments", F.length("desc_clean").alias("clean_chars"))


@query("updated_since")
def updated_since(spark: SparkSession, folder: str) -> DataFrame:
    feed = select.updated_since(bench.issue_feed(spark, folder), datetime(2024, 1, 15, 13, 30))
    return feed.select("event_id", "key", iso_format(F.col("updated")).alias("updated"))


@query("resolve_since")
def resolve_since(spark: SparkSession, folder: str) -> DataFrame:
    projects = bench.table(spark, folder, "documents").select(F.upper("source").alias("project")).distinct()
    number = F.substring("project", 4, 9).cast("int")
    start = F.when(number % 4 == 0, "2024-01-09").when(number % 4 == 1, "soon").when(number % 4 == 2, "")
    progress = metrics.last_update_by_project(bench.issue_feed(spark, folder))
    since = select.resolve_since(projects, progress, start, datetime(2024, 3, 1, 12))
    return since.select("project", iso_format(F.col("since")).alias("since"))


@query("resolution_flag")
def resolution_flag(spark: SparkSession, folder: str) -> DataFrame:
    return bench.comment_rows(spark, folder).select(
        "doc_id", "idx", contains_resolution_keywords(F.col("body")).alias("is_resolution"))


@query("project_from_key")
def project_from_key_parts(spark: SparkSession, folder: str) -> DataFrame:
    n = F.col("event_id")
    key = F.when(n % 4 == 0, F.concat("key", F.lit("-X"))).when(
        n % 4 == 1, F.replace("key", F.lit("-"), F.lit("_"))).otherwise(F.col("key"))
    return bench.issue_feed(spark, folder).select("event_id", project_from_key(key).alias("project"))


@query("project_from_url")
def project_from_url_parts(spark: SparkSession, folder: str) -> DataFrame:
    urls = bench.fetch_log(spark, folder).select("url").unionByName(
        bench.table(spark, folder, "pages").select("url"))
    return urls.groupBy(project_from_url(F.col("url")).alias("project")).agg(F.count(F.lit(1)).alias("n_urls"))


@query("issue_metadata")
def issue_metadata(spark: SparkSession, folder: str) -> DataFrame:
    issues = bench.issue_rows(spark, folder, ("events", "labels"))
    return issues.select(select.metadata(issues).alias("m")).select("m.*")


@query("comment_projection")
def comment_projection(spark: SparkSession, folder: str) -> DataFrame:
    return select.clean_comment_rows(bench.dated_comment_rows(spark, folder)).select(
        "key", "idx", "author", "body", "created")


@query("order_by_updated")
def order_by_updated(spark: SparkSession, folder: str) -> DataFrame:
    feed = select.order_by_updated(bench.issue_feed(spark, folder))
    return feed.select("event_id", "key", iso_format(F.col("updated")).alias("updated"))


# --- lookups ---


@query("drop_processed")
def drop_processed(spark: SparkSession, folder: str) -> DataFrame:
    feed = bench.issue_feed(spark, folder)
    processed = feed.filter("event_type = 'purchase' and updated < timestamp_ntz'2024-01-06 00:00:00'")
    return dedupe.drop_processed(feed, processed).select("event_id", "key")


@query("attach_progress")
def attach_progress(spark: SparkSession, folder: str) -> DataFrame:
    feed = bench.issue_feed(spark, folder)
    progress = metrics.last_update_by_project(feed.filter(
        "event_type = 'signup' and project <> 'SRC3' and updated < timestamp_ntz'2024-01-20 00:00:00'"))
    return select.resume(feed, progress).select("event_id", "project", iso_format(F.col("updated")).alias("updated"))


# --- aggregates ---


@query("corpus_count")
def corpus_count(spark: SparkSession, folder: str) -> DataFrame:
    prepared = bench.prepared_issues(spark, folder, counts=True, parts=("pages",))
    return metrics.corpus_count(select.has_content(prepared))


@query("issues_by_project")
def issues_by_project(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.issues_by_project(bench.issue_rows(spark, folder, ()))


@query("requests_by_status")
def requests_by_status(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.requests_by_project_status(bench.fetch_log(spark, folder))


@query("validation_errors")
def validation_errors(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.validation_errors(_parsed(spark, folder, broken=True))


@query("last_update_by_project")
def last_update_by_project(spark: SparkSession, folder: str) -> DataFrame:
    feed = bench.issue_feed(spark, folder)
    middle = "updated < timestamp_ntz'2024-01-16 00:00:00'"  # two deliveries, which make the whole feed
    old = metrics.last_update_by_project(feed.filter(middle))
    new = feed.filter(f"not {middle}").withColumn(
        "project", F.when(F.col("event_id") % 10 == 0, "  ").otherwise(F.col("project")))
    marks = metrics.last_update_by_project(new, old)
    return marks.select("project", iso_format(F.col("last_update")).alias("last_update"))


@query("raw_files_by_project")
def raw_files_by_project(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.raw_files_by_project(bench.issue_feed(spark, folder))


# --- top-k, limits, duplicates ---


@query("resolution_comments_topk")
def resolution_comments_topk(spark: SparkSession, folder: str) -> DataFrame:
    top = resolution_rows(bench.comment_rows(spark, folder), by="doc_id")
    return top.select("doc_id", "rank", "idx", clean_text(F.col("body")).alias("body"))


@query("limit_per_project")
def limit_per_project(spark: SparkSession, folder: str) -> DataFrame:
    feed = bench.issue_feed(spark, folder)
    order = ("updated", "key", "event_id")
    return select.limit_per_project(feed, 12, page=5, order=order).select("project", "position", "event_id")


@query("limit_per_project_large")
def limit_per_project_large(spark: SparkSession, folder: str) -> DataFrame:
    """A cap above the limit up to which Spark cuts groups before the shuffle."""
    order = ("updated", "key", "event_id")
    return select.limit_per_project(bench.issue_feed(spark, folder), 1190, order=order).select("project", "position", "event_id")


@query("dedupe_first")
def dedupe_first(spark: SparkSession, folder: str) -> DataFrame:
    return dedupe.dedupe_first(bench.issue_feed(spark, folder)).select("key", "event_id", "event_type")


@query("upsert_latest")
def upsert_latest(spark: SparkSession, folder: str) -> DataFrame:
    feed = bench.issue_feed(spark, folder)
    old = dedupe.dedupe_latest(feed.filter("updated < timestamp_ntz'2024-01-20 00:00:00'"))
    new = feed.filter("updated >= timestamp_ntz'2024-01-18 00:00:00'")
    return dedupe.upsert_latest(old, new).select("key", "event_id", iso_format(F.col("updated")).alias("updated"))


@query("append_processed")
def append_processed(spark: SparkSession, folder: str) -> DataFrame:
    marks = bench.issue_feed(spark, folder).select("key", F.col("updated").alias("processed_at"))
    middle = wall_clock(datetime(2024, 1, 16))
    ledger = dedupe.append_processed(
        marks.filter(F.col("processed_at") < middle), marks.filter(F.col("processed_at") >= middle), cap=40)
    return ledger.select("key", iso_format(F.col("processed_at")).alias("processed_at"))


@query("append_processed_all")
def append_processed_all(spark: SparkSession, folder: str) -> DataFrame:
    marks = bench.issue_feed(spark, folder).select("key", F.col("updated").alias("processed_at"))
    middle = wall_clock(datetime(2024, 1, 16))
    ledger = dedupe.append_processed(marks.filter(F.col("processed_at") < middle), marks.filter(F.col("processed_at") >= middle))
    return ledger.select("key", iso_format(F.col("processed_at")).alias("processed_at"))


@query("dedupe_ttl")
def dedupe_ttl(spark: SparkSession, folder: str) -> DataFrame:
    kept = dedupe.dedupe_ttl(bench.issue_feed(spark, folder), timedelta(days=7))
    return kept.select("key", "event_id", iso_format(F.col("updated")).alias("updated"))


# --- scalar functions ---


@query("clean_text")
def clean_text_pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = spread(bench.table(spark, folder, "pages"), "page_id")
    return pages.select("page_id", clean_text(F.col("html")).alias("clean"))


@query("parse_timestamps")
def parse_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    at, n = F.col("ts"), F.col("event_id")
    text = at.cast("string")
    day, clock = F.left(text, F.lit(10)), F.substring(text, 12, 8)
    given = (
        F.when(n % 8 == 0, F.concat(F.replace(iso_format(at), F.lit("+00:00"), F.lit("+0000"))))
        .when(n % 8 == 1, stored_format(at))
        .when(n % 8 == 2, F.concat(day, F.lit("T"), clock, F.lit("Z")))
        .when(n % 8 == 3, F.concat(day, F.lit("T"), clock, F.lit("+0530")))
        .when(n % 8 == 4, F.concat(day, F.lit(" "), clock))
        .when(n % 8 == 5, F.concat(F.replace(day, F.lit("-"), F.lit("")), F.lit("T"), F.replace(clock, F.lit(":"), F.lit(""))))
        .when(n % 8 == 6, F.concat(F.lit("about "), text))
        .otherwise(day))
    return bench.table(spark, folder, "events").select(
        "event_id", iso_format(parse_ts(given)).alias("parsed"))


@query("iso_timestamps")
def iso_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    at = F.when(F.col("event_id") % 4 == 0, F.expr("ts - make_dt_interval(0, 0, 0, extract(second from ts) % 1)")
                ).otherwise(F.col("ts"))
    return bench.table(spark, folder, "events").select(
        "event_id", iso_format(at).alias("iso"), stored_format(at).alias("stored"))


# --- derived tasks ---


@query("build_instruction")
def build_instruction(spark: SparkSession, folder: str) -> DataFrame:
    issues = bench.prepared_issues(spark, folder)
    return issues.select("key", tasks.instruction().alias("instruction"))


@query("build_response")
def build_response(spark: SparkSession, folder: str) -> DataFrame:
    issues = bench.prepared_issues(spark, folder, resolution=True, parts=("labels",))
    return issues.select("key", tasks.response().alias("response"))


@query("alpaca_format")
def alpaca_format(spark: SparkSession, folder: str) -> DataFrame:
    issues = bench.prepared_issues(spark, folder, resolution=True)
    override = F.when(F.col("doc_id") % 13 == 0, F.concat(F.lit("Explain "), F.col("key")))
    return tasks.alpaca(issues, instruction_text=override, keep=("key",))


@query("task_summarization")
def task_summarization(spark: SparkSession, folder: str) -> DataFrame:
    issues = bench.prepared_issues(spark, folder, first=True, parts=("pages", "labels"))
    return issues.select("key", tasks.summarization().alias("t")).select("key", "t.*")


@query("task_classification")
def task_classification(spark: SparkSession, folder: str) -> DataFrame:
    issues = bench.prepared_issues(spark, folder)
    return issues.select("key", tasks.classification().alias("t")).select("key", "t.*")


@query("task_qa")
def task_qa(spark: SparkSession, folder: str) -> DataFrame:
    issues = bench.prepared_issues(spark, folder, resolution=True, parts=("pages", "labels"))
    return issues.select("key", tasks.qa().alias("t")).select("key", "t.*")


@query("corpus")
def corpus(spark: SparkSession, folder: str) -> DataFrame:
    issues = select.has_content(bench.prepared_issues(spark, folder, first=True, resolution=True, counts=True))
    rows = tasks.all_tasks(issues, keep=("n_comments",))
    return rows.select(
        "metadata.*", "description", "n_comments",
        F.col("tasks.summarization.input").alias("summarization_input"),
        F.col("tasks.summarization.output").alias("summarization_output"),
        F.col("tasks.classification.input").alias("classification_input"),
        F.col("tasks.classification.output").alias("classification_output"),
        F.col("tasks.qa.question").alias("qa_question"), F.col("tasks.qa.context").alias("qa_context"),
        F.col("tasks.qa.answer").alias("qa_answer"))


# --- validation ---


@query("issue_violations")
def issue_violations(spark: SparkSession, folder: str) -> DataFrame:
    return _parsed(spark, folder, broken=True).select(_doc_id(), F.array_join("violations", ",").alias("codes"))


@query("quarantine")
def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    valid, invalid = split_valid(_parsed(spark, folder, broken=True))
    return valid.select(_doc_id(), "key", F.lit("valid").alias("outcome")).unionByName(
        invalid.select(_doc_id(), "key", F.lit("quarantined").alias("outcome")))


@query("validate_strict")
def validate_strict(spark: SparkSession, folder: str) -> DataFrame:
    """Without a broken document, a strict job passes every row; with one it fails (see the tests)."""
    return split_valid(_parsed(spark, folder), strict=True)[0].select(_doc_id(), "key")


# --- streams and jobs ---


@query("stream_ingest")
def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    out = scratch_path(spark, "stream-ingest")
    docs = streams.stream_documents(spark, _landed(spark, folder, broken=True), max_files=8, **LANDED)
    issues = parse_issue(docs).select("key", "path_project", F.size("violations").alias("n_violations"))
    streams.run_available(issues, scratch_path(spark, "checkpoint"), streams.append_by_batch(out))
    return spark.read.parquet(out).select("key", F.col("path_project").alias("project"), "n_violations")


DELIVERIES = 4


def _delivered(spark: SparkSession, folder: str, run: Callable[[DataFrame], object]) -> None:
    """Let the events come in deliveries that each span all times, and run the stream over what is new after each."""
    landing, events = scratch_path(spark, "events"), bench.table(spark, folder, "events")
    for n in range(DELIVERIES):
        events.filter(F.col("event_id") % DELIVERIES == n).write.mode("append").parquet(landing)
        feed = spark.readStream.schema(events.schema).parquet(landing)
        run(feed.select(
            F.concat(F.lit("USER-"), F.col("user_id").cast("string")).alias("key"),
            F.concat(F.lit("SRC"), (F.col("user_id") % 20).cast("string")).alias("project"),
            F.col("ts").alias("updated")))


@query("stream_dedupe")
def stream_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    out, checkpoint = scratch_path(spark, "stream-dedupe"), scratch_path(spark, "checkpoint")
    _delivered(spark, folder, lambda feed: streams.run_available(
        streams.stream_dedupe(feed).select("key", "project"), checkpoint, streams.append_by_batch(out)))
    return spark.read.parquet(out).select("key", "project")


@query("stream_dedupe_ledger")
def stream_dedupe_ledger(spark: SparkSession, folder: str) -> DataFrame:
    at, checkpoint = scratch_path(spark, "stream-ledger"), scratch_path(spark, "checkpoint")
    _delivered(spark, folder, lambda feed: streams.stream_dedupe_ledger(feed, checkpoint, at, timedelta(days=7)))
    return spark.read.parquet(f"{at}/kept").select("key", iso_format(F.col("updated")).alias("updated"))


@query("stream_dedupe_state")
def stream_dedupe_state(spark: SparkSession, folder: str) -> DataFrame:
    out, checkpoint = scratch_path(spark, "stream-state"), scratch_path(spark, "checkpoint")
    with streams.with_rocksdb(spark):
        _delivered(spark, folder, lambda feed: streams.run_available(
            streams.stream_dedupe_state(feed, timedelta(days=7)), checkpoint, streams.append_by_batch(out)))
    return spark.read.parquet(out).select("key", iso_format(F.col("updated")).alias("updated"))


@query("stream_progress")
def stream_progress(spark: SparkSession, folder: str) -> DataFrame:
    """The saved marks, and what the state store of the stream holds."""
    state, checkpoint = scratch_path(spark, "stream-progress"), scratch_path(spark, "checkpoint")
    _delivered(spark, folder, lambda feed: streams.stream_progress(feed, checkpoint, state))
    return load_progress(spark, state).select("project", iso_format(F.col("last_update")).alias("last_update"))


@query("stream_progress_audit")
def stream_progress_audit(spark: SparkSession, folder: str) -> DataFrame:
    state, checkpoint = scratch_path(spark, "stream-progress"), scratch_path(spark, "checkpoint")
    _delivered(spark, folder, lambda feed: streams.stream_progress(feed, checkpoint, state))
    held = streams.progress_in_state(spark, checkpoint).select("project", iso_format(F.col("last_update")).alias("in_state"))
    saved = load_progress(spark, state).select("project", iso_format(F.col("last_update")).alias("saved"))
    return held.join(saved, "project", "full")


@query("stream_counters")
def stream_counters(spark: SparkSession, folder: str) -> DataFrame:
    """Counters of a streamed job: issues per project, rejects per project and rule, over all its batches."""
    at = scratch_path(spark, "stream-counters")
    streams.stream_corpus(
        spark, _landed(spark, folder, broken=True), f"{at}/checkpoint", f"{at}/store", f"{at}/state", f"{at}/corpus",
        max_files=8, **LANDED, compression="gzip")
    return streams.read_counters(spark, f"{at}/state")


@query("stream_corpus")
def stream_corpus(spark: SparkSession, folder: str) -> DataFrame:
    at = scratch_path(spark, "stream-corpus")
    streams.stream_corpus(
        spark, _landed(spark, folder, broken=True), f"{at}/checkpoint", f"{at}/store", f"{at}/state", f"{at}/corpus",
        max_files=8, **LANDED, compression="gzip")
    lines = spark.read.option("recursiveFileLookup", "true").text(f"{at}/corpus").select(F.parse_json("value").alias("line"))
    return lines.select(
        F.variant_get("line", "$.metadata.issue_key", "string").alias("issue_key"),
        F.size(F.variant_get("line", "$.comments", "array<variant>")).alias("n_comments"),
        F.variant_get("line", "$.tasks.qa.answer", "string").alias("qa_answer"))


@query("ingest")
def ingest(spark: SparkSession, folder: str) -> DataFrame:
    at = scratch_path(spark, "ingest")
    docs = bench.raw_documents(spark, folder, broken=True).select("value", "source_path", "doc_id")
    # two deliveries that overlap: the second one repeats a third of the first
    ingest_documents(docs.filter("doc_id % 3 < 2"), f"{at}/store", f"{at}/state", batch=0)
    ingest_documents(docs.filter("doc_id % 3 > 0"), f"{at}/store", f"{at}/state", batch=1)
    stored = read_store(spark, f"{at}/store").select("key", F.lit("stored").alias("outcome"), "batch")
    rejected = read_quarantine(spark, f"{at}/state").select(
        F.concat(F.lit("doc "), F.col("source_path")).alias("key"),
        F.concat(F.lit("rejected: "), F.array_join("violations", ",")).alias("outcome"),
        F.col("batch").cast("bigint"))
    return stored.unionByName(rejected)


@query("ingest_latest")
def ingest_latest(spark: SparkSession, folder: str) -> DataFrame:
    at = scratch_path(spark, "ingest")
    docs = bench.raw_documents(spark, folder, broken=True).select("value", "source_path", "doc_id")
    for batch, part in enumerate(("doc_id % 3 < 2", "doc_id % 3 > 0")):
        ingest_documents(docs.filter(part), f"{at}/store", f"{at}/state", batch=batch, mode="latest")
    return read_store(spark, f"{at}/store", latest=True).select("key", iso_format(F.col("updated")).alias("updated"), "batch")


@query("ingest_resume")
def ingest_resume(spark: SparkSession, folder: str) -> DataFrame:
    """Half of the documents, then all of them from the day on up to which their project has been stored."""
    at = scratch_path(spark, "ingest")
    docs = bench.raw_documents(spark, folder, broken=True).select("value", "source_path", "doc_id")
    ingest_documents(docs.filter("doc_id % 4 < 2"), f"{at}/store", f"{at}/state", batch=0)
    ingest_documents(docs, f"{at}/store", f"{at}/state", batch=1, resume=True)
    return read_store(spark, f"{at}/store").select("key", "batch")


# --- fetch audits ---


@query("missing_pages")
def missing_pages(spark: SparkSession, folder: str) -> DataFrame:
    return fetch.missing_pages(bench.search_pages(spark, folder), page=10)


@query("missing_pages_capped")
def missing_pages_capped(spark: SparkSession, folder: str) -> DataFrame:
    return fetch.missing_pages(bench.search_pages(spark, folder), max_issues=400, page=10)


@query("missing_ranges")
def missing_ranges(spark: SparkSession, folder: str) -> DataFrame:
    return fetch.missing_ranges(bench.search_pages(spark, folder, mixed=True))


@query("retry_backlog")
def retry_backlog(spark: SparkSession, folder: str) -> DataFrame:
    return fetch.retry_backlog(bench.fetch_log(spark, folder))
