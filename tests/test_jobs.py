import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from conftest import comment, issue, stored
from pyspark.sql import functions as F

from ticketloom.functions.names import project_from_object_key
from ticketloom.plans.corpus import build_corpus, build_corpus_counted
from ticketloom.plans.ingest import ingest, ingest_documents, read_quarantine
from ticketloom.sinks.keyed import BUCKETS, batch_path, buckets_of, drop_merged, read_manifest
from ticketloom.sinks.tables import compact_ledger, compact_store, read_store, save_processed, save_progress, stored_json, write_raw
from ticketloom.sources.issues import parse_issue, read_raw
from ticketloom.sources.state import has_batch, load_processed, load_progress
from ticketloom.streaming.jobs import (
    append_by_batch, progress_in_state, read_counters, run_available, state_operators, stream_corpus, stream_dedupe, stream_dedupe_ledger,
    stream_dedupe_state, stream_progress, with_rocksdb,
)


def put(folder: Path, name: str, doc) -> None:
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(doc if isinstance(doc, str) else json.dumps(doc, indent=2, ensure_ascii=False), encoding="utf-8")


def lines(folder):
    return [json.loads(line) for f in Path(folder).rglob("part-*") for line in f.read_text(encoding="utf-8").splitlines()]


@pytest.fixture
def raw(tmp_path):
    """Old and new layout side by side, a broken file, an empty issue and another project."""
    root = tmp_path / "raw"
    for n in range(5):
        put(root, f"WEB/WEB-{n}.json", stored(f"WEB-{n}"))
        put(root, f"WEB-{n}.json", stored(f"WEB-{n}", project=""))
    put(root, "WEB/broken.json", "{")
    put(root, "WEB/WEB-9.json", issue("WEB-9", description="<br>"))
    put(root, "APP/APP-1.json", issue("APP-1", description="naïve ☃"))
    put(root, "APP/notes.txt", "no issue")
    return str(root)


def test_build_corpus(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    assert build_corpus(spark, raw, out) == 6
    rows = {r["metadata"]["issue_key"]: r for r in lines(out)}
    assert len(rows) == 6 and rows["APP-1"]["description"] == "naïve ☃"
    assert rows["WEB-1"]["comments"][0]["body"] == "a patch" and "assignee" not in rows["WEB-1"]["metadata"]
    assert "naïve ☃" in "".join(f.read_text(encoding="utf-8") for f in Path(out).glob("part-*"))


def test_build_corpus_variants(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    assert build_corpus(spark, raw, out, dedupe=False) == 11
    assert build_corpus(spark, raw, out, projects=["APP"]) == 1
    assert build_corpus(spark, raw, out, projects=["WEB"], dedupe=False) == 10
    assert build_corpus(spark, raw, out, shape="api") == 1
    assert build_corpus(spark, str(tmp_path / "missing"), out) == 0


def test_build_corpus_counts_rejects_and_takes_form_and_keywords(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    built = build_corpus_counted(spark, raw, out, form="instructions", keywords=["nothing"])
    assert built == (6, 13, 1) and {frozenset(r) for r in lines(out)} == {frozenset(("instruction", "response", "input"))}
    assert not any("a patch" in r["response"] for r in lines(out))
    build_corpus(spark, raw, out, form="instructions")
    assert sum("a patch" in r["response"] for r in lines(out)) == 5


def test_object_store_rule_uses_the_second_component(spark, raw):
    # the key of an object begins below the bucket; for a local path that is below the root
    names = {r.path_project for r in read_raw(spark, "file://" + raw, store="object").select("path_project").collect()}
    assert names == {Path(raw).parts[1]}
    uris = {"s3a://bucket/raw/WEB/WEB-1.json": "WEB", "gs://b/raw/APP/x/y.json": "APP", "s3a://b/raw/WEB-1.json": None, "s3a://b/x.json": None}
    df = spark.createDataFrame([(u,) for u in uris], "uri string").select("uri", project_from_object_key(F.col("uri")).alias("p"))
    assert {r.uri: r.p for r in df.collect()} == uris


def test_ingest_first_and_latest(spark, tmp_path):
    landing, store, state = (str(tmp_path / n) for n in ("landing", "store", "state"))
    put(Path(landing), "WEB/1.json", issue("WEB-1", summary="one"))
    put(Path(landing), "WEB/2.json", issue("WEB-2", summary=None))
    assert {r.key for r in ingest(spark, landing, store, state, batch=0).collect()} == {"WEB-1"}
    put(Path(landing), "WEB/3.json", issue("WEB-1", summary="two", updated="2024-02-01T00:00:00.000+0000"))
    put(Path(landing), "WEB/4.json", issue("WEB-3"))
    assert {r.key for r in ingest(spark, landing, store, state, batch=1).collect()} == {"WEB-3"}
    with pytest.raises(ValueError):  # a complete number is not written over by chance
        ingest(spark, landing, store, state, batch=1)
    ingest(spark, landing, store, state, batch=1, replace=True)  # again: same tables
    assert sorted(r.key for r in read_store(spark, store).collect()) == ["WEB-1", "WEB-3"]
    assert sorted(r.key for r in load_processed(spark, state).collect()) == ["WEB-1", "WEB-3"]
    assert [(r.violations, r.batch) for r in read_quarantine(spark, state).orderBy("batch").collect()] == [(["summary"], 0), (["summary"], 1)]

    ingest(spark, landing, store, state, batch=2, mode="latest")
    latest = {r.key: r.summary for r in read_store(spark, store, latest=True).collect()}
    assert latest == {"WEB-1": "two", "WEB-3": "Broken link"}
    assert load_progress(spark, state).first().last_update == datetime(2024, 2, 1)


def test_ingest_strict(spark, tmp_path):
    put(tmp_path / "landing", "1.json", issue("WEB-1", summary=None))
    with pytest.raises(Exception, match="invalid issue WEB-1"):
        ingest(spark, str(tmp_path / "landing"), str(tmp_path / "s"), str(tmp_path / "t"), batch=0, strict=True)


def test_json_store_keeps_whole_objects(spark, docs, tmp_path):
    put(tmp_path / "landing", "1.json", issue(status={"name": "Open", "id": "3", "more": {"a": [1]}}, comment={"comments": [
        comment(author={"displayName": "Bob", "active": True})]}))
    store = str(tmp_path / "store")
    ingest(spark, str(tmp_path / "landing"), store, str(tmp_path / "state"), batch=0, form="json")
    (doc,) = [json.loads(x) for f in Path(store).rglob("part-*") for x in f.read_text().splitlines()]
    assert doc["fields"]["status"] == {"name": "Open", "id": "3", "more": {"a": [1]}}
    assert doc["fields"]["assignee"] is None and doc["fields"]["comments"] is None
    assert doc["comments"][0]["author"] == {"displayName": "Bob", "active": True}
    assert doc["fields"]["created"] == "2024-01-09 08:45:12+00:00"
    row = read_store(spark, store, form="json").first()
    assert (row.key, row.project, row.comments[0].author, row.batch) == ("WEB-1", "WEB", "Bob", 0)


def test_stored_form_parses_to_the_same_issue(docs):
    first = parse_issue(docs([issue(comment={"comments": [comment()]}), issue("WEB-2", assignee={"displayName": "Z"})]))
    columns = [c for c in first.columns if c not in ("raw", "value", "source_path")]
    again = parse_issue(stored_json(first))
    assert first.select(*columns).orderBy("key").collect() == again.select(*columns).orderBy("key").collect()


def test_state_survives_and_damage_is_an_error(spark, tmp_path):
    folder = str(tmp_path / "state")
    assert load_progress(spark, folder).count() == 0
    mark = spark.createDataFrame([("WEB", datetime(2024, 1, 2))], "project string, last_update timestamp_ntz")
    save_progress(mark, folder, 0)
    save_progress(mark.selectExpr("project", "last_update - interval 1 day as last_update"), folder, 1)
    assert load_progress(spark, folder).collect() == mark.collect()
    keys = spark.createDataFrame([("WEB-1", datetime(2024, 1, 2))], "key string, processed_at timestamp_ntz")
    save_processed(keys, folder, 0)
    assert load_processed(spark, folder, without=("job", 0)).count() == 0
    assert load_processed(spark, folder, without=("stream", 0)).count() == 1
    for part in Path(folder, "processed").rglob("part-*.parquet"):
        part.write_bytes(b"damaged")
        part.with_name(f".{part.name}.crc").unlink()
    with pytest.raises(Exception, match="(?i)parquet|footer|corrupt"):
        load_processed(spark, folder).select("key").collect()


def test_job_and_streams_share_a_store(spark, tmp_path):
    landing, at = tmp_path / "landing", str(tmp_path / "at")
    put(landing, "WEB/1.json", issue("WEB-1"))
    ingest(spark, str(landing), f"{at}/store", f"{at}/state", batch=7)
    for n, key in enumerate(("WEB-2", "WEB-3")):  # two checkpoints, whose numbers both start at 0
        put(landing, f"WEB/{key}.json", issue(key))
        stream_corpus(spark, str(landing), f"{at}/cp{n}", f"{at}/store", f"{at}/state", f"{at}/corpus")
    assert sorted(r.key for r in read_store(spark, f"{at}/store").collect()) == ["WEB-1", "WEB-2", "WEB-3"]
    assert sorted(r["metadata"]["issue_key"] for r in lines(f"{at}/corpus")) == ["WEB-2", "WEB-3"]


def test_a_batch_is_replaced_as_a_whole_whatever_the_session_says(spark, tmp_path):
    landing, at = tmp_path / "landing", str(tmp_path / "at")
    put(landing, "WEB/1.json", issue("WEB-1"))
    put(landing, "APP/2.json", issue("APP-2"))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        ingest(spark, str(landing), f"{at}/store", f"{at}/state", batch=0)
        again = ingest(spark, str(landing), f"{at}/store", f"{at}/state", batch=0, projects=["WEB"], replace=True)
        assert [r.key for r in again.collect()] == ["WEB-1"]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_the_newer_batch_wins_a_tie(spark, tmp_path):
    landing, at = tmp_path / "landing", str(tmp_path / "at")
    for n in range(4):
        put(landing, f"{n}/WEB/1.json", issue("WEB-1", summary=f"version {n}"))
        ingest(spark, str(landing / str(n)), f"{at}/store", f"{at}/state", batch=n, mode="latest")
    assert [r.summary for r in read_store(spark, f"{at}/store", latest=True).collect()] == ["version 3"]


def test_late_rows_are_kept_in_any_order_of_deliveries(spark, tmp_path):
    schema = "key string, updated timestamp_ntz"
    source, at = str(tmp_path / "in"), str(tmp_path / "at")
    start = datetime(2024, 1, 1)
    days = [200, 1, 90, 2, 201, 150, 91, 3, 199]
    for n in days:
        spark.createDataFrame([("a", start + timedelta(days=n))], schema).coalesce(1).write.mode("append").parquet(source)
        stream_dedupe_ledger(spark.readStream.schema(schema).parquet(source), f"{at}/cp", f"{at}/ledger", timedelta(days=4))
    kept = {(r.updated - start).days for r in spark.read.parquet(f"{at}/ledger/kept").collect()}
    assert kept == {200, 1, 90, 150}


def test_two_checkpoints_share_a_folder(spark, tmp_path):
    schema = "key string, project string, updated timestamp_ntz"
    at, day = str(tmp_path / "at"), datetime(2024, 1, 1)
    for name in ("one", "two"):
        spark.createDataFrame([(name, name, day)], schema).coalesce(1).write.parquet(f"{at}/in-{name}")
        feed = spark.readStream.schema(schema).parquet(f"{at}/in-{name}")
        stream_dedupe_ledger(feed, f"{at}/cp-{name}", f"{at}/ledger", timedelta(days=4))
        stream_progress(feed, f"{at}/cp2-{name}", f"{at}/ledger")
    assert {r.key for r in spark.read.parquet(f"{at}/ledger/kept").collect()} == {"one", "two"}
    assert {r.project for r in spark.read.parquet(f"{at}/ledger/progress").collect()} == {"one", "two"}


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    landing, at = tmp_path / "landing", str(tmp_path / "at")
    put(landing, "WEB/1.json", issue("WEB-1"))
    put(landing, "WEB/2.json", issue("WEB-2", summary=None))
    run = lambda: stream_corpus(spark, str(landing), f"{at}/cp", f"{at}/store", f"{at}/state", f"{at}/corpus", max_files=1)
    run()
    put(landing, "WEB/3.json", issue("WEB-1", summary="again"))
    put(landing, "APP/4.json", issue("APP-1"))
    run()
    run()
    rows = lines(f"{at}/corpus")
    assert sorted(r["metadata"]["issue_key"] for r in rows) == ["APP-1", "WEB-1"]
    assert {r["metadata"]["title"] for r in rows} == {"Broken link"}
    assert read_quarantine(spark, f"{at}/state").count() == 1


def test_streamed_duplicates_over_two_runs(spark, tmp_path):
    schema = "key string, updated timestamp_ntz"
    day = lambda n: datetime(2024, 1, n)
    source, at = str(tmp_path / "in"), str(tmp_path / "at")
    deliveries = [[("a", day(1)), ("a", day(3)), ("b", day(2))], [("a", day(5)), ("a", day(9)), ("b", day(1)), ("b", day(4))]]
    kept = set()
    for rows in deliveries:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        feed = spark.readStream.schema(schema).parquet(source)
        stream_dedupe_ledger(feed, f"{at}/cp", f"{at}/ledger", timedelta(days=4))
        run_available(stream_dedupe(feed, "4 days"), f"{at}/cp2", append_by_batch(f"{at}/watermark"))
    kept = {(r.key, r.updated.day) for r in spark.read.parquet(f"{at}/ledger/kept").collect()}
    assert kept == {("a", 1), ("a", 5), ("a", 9), ("b", 2)}
    first = {r.key for r in spark.read.parquet(f"{at}/watermark").collect()}
    assert first == {"a", "b"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files_read(df):
    """Files that the scans of a plan open."""
    executed = df._jdf.queryExecution()
    executed.toRdd().count()
    found, stack = 0, [executed.executedPlan()]
    while stack:
        node = stack.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
            continue
        if node.metrics().contains("numFiles"):
            found += node.metrics().apply("numFiles").value()
        stack += [node.children().apply(i) for i in range(node.children().size())]
    return found


def versions(docs, *rows):
    return parse_issue(docs([issue(key, summary=summary, updated=f"2024-02-{day:02}T00:00:00.000+0000") for key, summary, day in rows]))


def test_a_merged_store_has_one_row_per_key_and_reads_without_a_shuffle(spark, docs, tmp_path):
    store = str(tmp_path / "store")
    latest = lambda: {r.key: (r.summary, r.batch) for r in read_store(spark, store, latest=True).collect()}
    write_raw(versions(docs, ("WEB-1", "a", 5), ("WEB-2", "a", 5), ("APP-1", "a", 5)), store, 0)
    write_raw(versions(docs, ("WEB-1", "b", 7), ("WEB-2", "b", 3), ("WEB-4", "b", 5)), store, 1)
    want = {"WEB-1": ("b", 1), "WEB-2": ("a", 0), "APP-1": ("a", 0), "WEB-4": ("b", 1)}
    assert latest() == want and compact_store(spark, store) == 1 and latest() == want
    merged = read_store(spark, store, latest=True)
    assert "Exchange" not in plan(merged) and merged.count() == 4
    assert compact_store(spark, store) == 1  # nothing new
    # a later batch replaces, ties go to it, late versions do not
    write_raw(versions(docs, ("WEB-1", "c", 7), ("WEB-2", "c", 4), ("WEB-5", "c", 1)), store, 2)
    want |= {"WEB-1": ("c", 2), "WEB-5": ("c", 2)}
    assert latest() == want and {r.key for r in read_store(spark, store, latest=True, projects=["APP"]).collect()} == {"APP-1"}
    assert compact_store(spark, store) == 2 and latest() == want and "Exchange" not in plan(read_store(spark, store, latest=True))
    drop_merged(spark, store)
    assert latest() == want and not Path(batch_path(store, "job", 0)).exists()
    write_raw(versions(docs, ("WEB-9", "d", 9)), store, 3)
    assert latest() == want | {"WEB-9": ("d", 3)}


def test_a_merge_that_stopped_half_way_is_not_seen(spark, docs, tmp_path):
    store = str(tmp_path / "store")
    write_raw(versions(docs, ("WEB-1", "a", 5)), store, 0)
    compact_store(spark, store)
    write_raw(versions(docs, ("WEB-1", "b", 6)), store, 1)
    # files of a generation without a manifest, and a manifest that lacks rows
    write_raw(versions(docs, ("WEB-1", "lost", 9)), f"{store}/_live/generation=2/bucket=0", 0)
    spark.createDataFrame([(3, 0, 2)], "entries long, bucket int, generation long").write.json(f"{store}/_manifest/version=2")
    assert read_manifest(spark, store).version == 1
    assert [r.summary for r in read_store(spark, store, latest=True).collect()] == ["b"]


def test_a_ledger_lookup_opens_only_its_buckets(spark, tmp_path):
    folder, at = str(tmp_path / "state"), datetime(2024, 1, 2)
    schema = "key string, processed_at timestamp_ntz"
    for batch in range(3):
        save_processed(spark.createDataFrame([(f"K-{n}", at + timedelta(batch)) for n in range(batch * 100, batch * 100 + 300)], schema), folder, batch)
    few = spark.createDataFrame([("K-7",), ("K-250",), ("Z-1",)], "key string")
    assert len(buckets_of(few)) <= 3 < BUCKETS
    whole = files_read(load_processed(spark, folder))
    known = load_processed(spark, folder, keys=few)
    assert files_read(known) <= 9 < whole
    assert {r.key for r in known.join(few, "key", "left_semi").collect()} == {"K-7", "K-250"}
    assert load_processed(spark, folder, without=("job", 2)).count() == 600
    # merged: one mark per key, its latest; a repeated batch still leaves its own out
    compact_ledger(spark, folder)
    merged = load_processed(spark, folder)
    assert merged.count() == 500 == merged.select("key").distinct().count() and files_read(load_processed(spark, folder, keys=few)) <= 3
    assert merged.where("key = 'K-250'").first().processed_at == at + timedelta(2)
    assert load_processed(spark, folder, without=("job", 2)).count() == 200


def test_completion_does_not_hang_on_marker_files(spark, tmp_path):
    put(tmp_path / "landing", "1.json", issue("WEB-1"))
    name = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    spark.sparkContext._jsc.hadoopConfiguration().set(name, "false")
    try:
        ingest(spark, str(tmp_path / "landing"), str(tmp_path / "s"), str(tmp_path / "t"), batch=0)
        assert has_batch(spark, str(tmp_path / "t"), "job", 0) and not list(tmp_path.rglob("_SUCCESS"))
        with pytest.raises(ValueError):
            ingest(spark, str(tmp_path / "landing"), str(tmp_path / "s"), str(tmp_path / "t"), batch=0)
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset(name)


def test_a_checkpoint_made_anew_is_another_writer(spark, tmp_path):
    at = str(tmp_path / "at")
    for n, key in enumerate(("WEB-1", "WEB-2")):
        put(tmp_path / f"landing{n}", "WEB/1.json", issue(key))
        stream_corpus(spark, str(tmp_path / f"landing{n}"), f"{at}/cp", f"{at}/store", f"{at}/state", f"{at}/corpus")
        Path(f"{at}/cp").rename(f"{at}/cp-old{n}")
    assert sorted(r.key for r in read_store(spark, f"{at}/store").collect()) == ["WEB-1", "WEB-2"]
    # another spelling of a path is the same writer: nothing is read twice
    Path(f"{at}/cp-old1").rename(f"{at}/cp")
    put(tmp_path / "landing1", "WEB/2.json", issue("WEB-3"))
    stream_corpus(spark, str(tmp_path / "landing1"), f"file://{at}/cp/", f"{at}/store", f"{at}/state", f"{at}/corpus")
    rows = read_store(spark, f"{at}/store").collect()
    assert sorted(r.key for r in rows) == ["WEB-1", "WEB-2", "WEB-3"] and len({r.writer for r in rows}) == 2


def test_state_keeps_rows_apart_whatever_their_order(spark, tmp_path):
    schema = "key string, project string, updated timestamp_ntz, n int"
    source, at, start = str(tmp_path / "in"), str(tmp_path / "at"), datetime(2024, 1, 1)
    days = [[20, 24], [1, 3], [9, 9], [2, 28], [21, 30], [15, 16], [11, 5], [4, 40]]
    for n, some in enumerate(days):  # eight files, one per micro-batch, late rows among them
        rows = [(k, "P", start + timedelta(days=d), n) for k in ("a", "b") for d in some] + [(None, "P", start, n), ("a", "P", None, n)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(source)
    with with_rocksdb(spark):
        run_available(stream_dedupe_state(feed, timedelta(days=4)), f"{at}/cp", append_by_batch(f"{at}/out"))
    stream_progress(feed, f"{at}/cp2", f"{at}/state")
    kept, marks = [], []
    for d in [x for some in days for x in sorted(some)]:
        if all(abs(d - m) >= 4 for m in marks):
            marks.append(d)
            kept.append(d)
    rows = spark.read.parquet(f"{at}/out").collect()
    assert sorted((r.key, (r.updated - start).days) for r in rows) == sorted((k, d) for k in ("a", "b") for d in kept)
    assert [tuple(r) for r in progress_in_state(spark, f"{at}/cp2").collect()] == [("P", start + timedelta(days=40))]
    assert state_operators(spark, f"{at}/cp2").first()["operatorName"] == "stateStoreSave"


def test_counters_add_up_over_batches_and_resume_skips_old_days(spark, tmp_path):
    landing, at = tmp_path / "landing", str(tmp_path / "at")
    for n, key in enumerate(("WEB-1", "WEB-2", "APP-3")):
        put(landing, f"{key[:3]}/{n}.json", issue(key, summary=None if n == 1 else "x"))
    stream_corpus(spark, str(landing), f"{at}/cp", f"{at}/store", f"{at}/state", f"{at}/corpus", max_files=1)
    assert {tuple(r) for r in read_counters(spark, f"{at}/state").collect()} == {("WEB", "stored", 1), ("APP", "stored", 1), ("WEB", "summary", 1)}
    put(landing, "WEB/8.json", issue("WEB-8", updated="2024-01-10T23:00:00.000+0000"))
    put(landing, "WEB/9.json", issue("WEB-9", updated="2024-01-11T01:00:00.000+0000"))
    got = ingest(spark, str(landing), f"{at}/store", f"{at}/state", batch=0, resume=True)
    assert [r.key for r in got.collect()] == ["WEB-9"]


def sizes(folder, pattern="part-*"):
    return [f.stat().st_size for f in Path(folder).rglob(pattern)]


def test_the_parsed_copy_of_a_batch_holds_what_the_batch_takes(spark, docs, tmp_path, monkeypatch):
    copies = []
    monkeypatch.setattr("ticketloom.plans.ingest.discard", lambda _, path: copies.append(path))
    batch = docs([issue("WEB-1", description="kept"), issue("WEB-2", summary=None, description="refused")])
    for form in ("parquet", "json"):
        ingest_documents(batch, str(tmp_path / form / "s"), str(tmp_path / form / "t"), 0, form=form)
    plain, whole = (spark.read.parquet(path) for path in copies)
    assert "raw" not in plain.columns and whole.where("raw is not null").count() == 1
    for copy in (plain, whole):
        rows = {r.key: r for r in copy.collect()}
        assert rows["WEB-1"].value is None and rows["WEB-1"].description == "kept"
        assert "refused" in rows["WEB-2"].value and rows["WEB-2"].description is None and rows["WEB-2"].comments is None
    for form in ("parquet", "json"):
        (bad,) = read_quarantine(spark, str(tmp_path / form / "t")).collect()
        assert bad.key == "WEB-2" and bad.project == "WEB" and list(bad.violations) == ["summary"] and "refused" in bad.value
        assert [r.key for r in read_store(spark, str(tmp_path / form / "s"), form).collect()] == ["WEB-1"]


def test_a_small_ledger_batch_is_small(spark, tmp_path):
    keys = spark.createDataFrame([(f"K-{n}", datetime(2024, 1, 2)) for n in range(640)], "key string, processed_at timestamp_ntz")
    save_processed(keys, str(tmp_path), 0)
    # a Bloom filter of fixed size takes a megabyte of every file
    assert sum(sizes(tmp_path, "part-*.parquet")) < 64 * 100_000
    assert load_processed(spark, str(tmp_path), keys=keys.limit(3)).join(keys.limit(3), "key", "left_semi").count() == 3


def test_a_packed_corpus_reads_as_the_plain_one(spark, raw, tmp_path):
    plain, packed = str(tmp_path / "plain"), str(tmp_path / "packed")
    assert build_corpus(spark, raw, plain) == build_corpus(spark, raw, packed, compression="gzip") == 6
    assert sorted(r.value for r in spark.read.text(plain).collect()) == sorted(r.value for r in spark.read.text(packed).collect())
    assert sizes(packed, "part-*.json.gz") and not sizes(plain, "*.gz")


def test_a_streamed_corpus_may_be_packed(spark, tmp_path):
    put(tmp_path / "landing", "WEB/1.json", issue("WEB-1", description="text " * 200))
    at = [str(tmp_path / n) for n in ("landing", "checkpoint", "store", "state", "corpus")]
    stream_corpus(spark, *at, compression="gzip")
    assert sizes(at[-1], "part-*.json.gz") and not sizes(at[-1], "part-*.json")
    (line,) = spark.read.option("recursiveFileLookup", "true").text(at[-1]).collect()
    assert json.loads(line.value)["metadata"]["issue_key"] == "WEB-1"


def test_pending_batches_are_read_without_a_copy_of_their_rows(spark, docs, tmp_path, monkeypatch):
    copies = []
    monkeypatch.setattr("ticketloom.sinks.keyed.written", lambda df, label: copies.append(df.columns) or df)
    store = str(tmp_path / "store")
    for batch, (key, name) in enumerate((("WEB-1", "one"), ("WEB-2", "two"), ("WEB-1", "three"), ("WEB-1", "four"))):
        write_raw(parse_issue(docs([issue(key, summary=name)])), store, batch)
        if batch == 1:
            compact_store(spark, store)
    assert {(r.key, r.summary, r.batch) for r in read_store(spark, store, latest=True).collect()} == {("WEB-1", "four", 3), ("WEB-2", "two", 1)}
    assert copies == [["key"]]
