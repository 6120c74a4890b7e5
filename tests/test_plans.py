"""What the physical plans must look like."""

import re

import pytest
from conftest import SMALL, issue

from ticketloom.plans.catalog import QUERIES
from ticketloom.plans.corpus import corpus_from_issues
from ticketloom.sinks.tables import read_store, write_raw
from ticketloom.sources.bench_tables import raw_documents
from ticketloom.sources.issues import parse_issue, read_raw

FILES = {"raw_scan", "raw_roundtrip", "corpus_jsonl_roundtrip", "corpus_alpaca_roundtrip", "corpus_rejects", "ingest", "ingest_latest",
         "ingest_resume", "store_latest", "state_roundtrip", "dedupe_ttl"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in FILES and not n.startswith("stream_")))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        assert node not in text or (name == "corpus_count" and node == "SinglePartition"), node


def test_day_bound_reaches_the_scan(spark):
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan(QUERIES["updated_since"](spark, SMALL))


def test_duplicates_are_cut_before_the_shuffle(spark):
    for name, limit in (("dedupe_first", 1), ("limit_per_project", 15), ("task_qa", 3), ("task_summarization", 5)):
        text = plan(QUERIES[name](spark, SMALL))
        assert re.search(rf"row_number\(\), {limit}, Partial", text), name


def test_every_table_is_shuffled_once(spark):
    # as on a cluster: no broadcast, and as many partitions as a small scan is dealt to
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism)
    try:
        text = plan(QUERIES["corpus"](spark, SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert text.count("Exchange hashpartitioning") == text.count("FileScan parquet") == 7


def test_small_lookups_are_broadcast(spark):
    assert "BroadcastHashJoin" in plan(QUERIES["drop_processed"](spark, SMALL))
    assert "LeftAnti" in plan(QUERIES["drop_processed"](spark, SMALL))


@pytest.mark.parametrize("dedupe", [True, False])
def test_text_is_parsed_and_cleaned_once(spark, docs, tmp_path, dedupe):
    docs([issue()]).write.parquet(str(tmp_path / "d"))
    issues = parse_issue(spark.read.parquet(str(tmp_path / "d"))).filter("size(violations) = 0")
    text = plan(corpus_from_issues(issues.drop("raw", "value", "violations"), dedupe))
    assert text.count("parseJson") == 1
    assert text.count("<[^>]+>") == 2  # description, and comment bodies


def test_project_filter_prunes_folders_and_files(spark, docs, tmp_path):
    store = str(tmp_path / "store")
    write_raw(parse_issue(docs([issue(), issue("APP-1")])), store, batch=0)
    assert re.search(r"PartitionFilters: \[[^\]]*project#\d+ = WEB", plan(read_store(spark, store, projects=["WEB"])))

    for name in ("WEB/WEB-1", "APP/APP-1", "APP/APP-2", "WEB-3"):
        path = tmp_path / "raw" / f"{name}.json"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("{}")
    df = read_raw(spark, str(tmp_path / "raw"), ["WEB"])
    executed = df._jdf.queryExecution()
    assert executed.toRdd().count() == 2
    node = executed.executedPlan()
    while node.children().size():
        node = node.children().head()
    assert node.metrics().apply("numFiles").value() == 2


def test_raw_documents_are_shuffled_once_whatever_the_number_of_partitions(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 3 * spark.sparkContext.defaultParallelism)
    try:
        text = plan(raw_documents(spark, SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert text.count("Exchange hashpartitioning") == text.count("FileScan parquet") == 6
