import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ticketloom.operators import dedupe, fetch, metrics, select
from ticketloom.sources.pages import parse_search_pages

START = datetime(2024, 1, 1)


@pytest.fixture
def feed(spark):
    """A feed in which one project and one key hold a third of the rows."""
    rnd = random.Random(5)
    rows = []
    for n in range(900):
        key = "HOT-1" if n % 3 == 0 else f"P{rnd.randint(0, 5)}-{rnd.randint(0, 40)}"
        at = START + timedelta(hours=rnd.randint(0, 1500))
        rows.append((key, key.split("-")[0], at, f"f/{n:04d}", n))
    df = spark.createDataFrame(rows, "key string, project string, updated timestamp_ntz, source_path string, n int")
    return rows, df.repartition(4)


def test_first_and_latest_per_key(feed):
    rows, df = feed
    first, last = {}, {}
    for r in sorted(rows, key=lambda r: (r[2], r[3])):
        first.setdefault(r[0], r[4])
        last[r[0]] = r[2]
    assert {r.key: r.n for r in dedupe.dedupe_first(df).collect()} == first
    assert {r.key: r.updated for r in dedupe.dedupe_latest(df).collect()} == last


def test_upsert_keeps_one_row_per_key_and_new_wins_a_tie(spark):
    schema = "key string, updated timestamp_ntz, v string"
    old = spark.createDataFrame([("a", START, "old"), ("b", START, "old"), ("c", START + timedelta(1), "old")], schema)
    new = spark.createDataFrame([("a", START, "new"), ("c", START, "new"), ("d", START, "x"), ("d", START + timedelta(1), "y")], schema)
    got = {r.key: r.v for r in dedupe.upsert_latest(old, new).collect()}
    assert got == {"a": "new", "b": "old", "c": "old", "d": "y"}


def test_ledger(spark):
    schema = "key string, processed_at timestamp_ntz"
    ledger = spark.createDataFrame([("a", START), ("b", START)], schema)
    more = spark.createDataFrame([("b", START + timedelta(2)), ("c", START + timedelta(1))], schema)
    assert dedupe.append_processed(ledger, more).count() == 3
    assert [r.key for r in dedupe.append_processed(ledger, more, cap=2).collect()] == ["b", "c"]
    issues = spark.createDataFrame([("a",), ("z",)], "key string")
    assert [r.key for r in dedupe.drop_processed(issues, ledger).collect()] == ["z"]


def test_the_ledger_is_first_reduced_to_the_batch(spark):
    ledger = spark.createDataFrame([("a", START), ("b", START)], "key string, processed_at timestamp_ntz")
    issues = spark.createDataFrame([("a",), ("a",), ("z",)], "key string")
    plans = []
    for limit in ("-1", "10m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            fresh = dedupe.drop_processed(issues, ledger)
            assert [r.key for r in fresh.collect()] == ["z"]
            plans.append(fresh._jdf.queryExecution().optimizedPlan().toString())
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert all("LeftSemi" in p and "LeftAnti" in p for p in plans)  # one plan, whatever the size


def test_marks_hold_for_the_ttl(spark):
    marks = spark.createDataFrame([("a", START), ("a", START + timedelta(days=1))], "key string, processed_at timestamp_ntz")
    rows = [("a", START + timedelta(days=n)) for n in (0, 3, 4)] + [("b", START)]
    df = spark.createDataFrame(rows, "key string, updated timestamp_ntz")
    got = {(r.key, (r.updated - START).days) for r in dedupe.drop_marked(df, marks, timedelta(days=3)).collect()}
    assert got == {("a", 4), ("b", 0)}


def test_feed_order(spark):
    df = spark.createDataFrame([("b", START), ("a", START), ("c", START - timedelta(1))], "key string, updated timestamp_ntz")
    assert [r.key for r in select.order_by_updated(df).collect()] == ["c", "a", "b"]


def chain(times, ttl):
    kept = []
    for t in sorted(set(times)):
        if not kept or t >= kept[-1] + ttl:
            kept.append(t)
    return kept


@pytest.mark.parametrize("ttl, ranges", [(timedelta(days=6, hours=5), 4), (timedelta(days=9), 20)])
def test_ttl_counts_from_the_last_kept_row(spark, feed, ttl, ranges):
    rows, df = feed
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)  # with 20 the hot key fills several ranges
    try:
        got = dedupe.dedupe_ttl(df, ttl).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = {(k, t) for k in {r[0] for r in rows} for t in chain([r[2] for r in rows if r[0] == k], ttl)}
    assert {(r.key, r.updated) for r in got} == want and len(got) == len(want)


def test_ttl_over_one_key_with_a_long_chain(spark):
    # 40,000 distinct times of one key, 20,000 of them kept, without a gap that would end the chain
    minutes = F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz")
    df = spark.range(40_000).select(F.lit("HOT-1").alias("key"), minutes.alias("updated"), "id").repartition(6)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("ttl", "")
    kept = [r.id for r in dedupe.dedupe_ttl(df, timedelta(seconds=90)).select("id").collect()]
    jobs = len(tracker.getJobIdsForGroup("ttl"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(kept) == list(range(0, 40_000, 2)) and jobs < 200  # rounds grow with the logarithm: 15 of them


def test_pointers_give_what_the_walk_gives(feed):
    rows, df = feed
    times = df.select(F.col("key").alias("_k"), F.unix_micros(F.col("updated").cast("timestamp")).alias("_t")).distinct()
    ttl = timedelta(days=3)
    micros = int(ttl.total_seconds() * 1_000_000)
    got = {(r["_k"], r["_t"]) for r in dedupe.followed_times(times, micros).collect()}
    assert got == {(r["_k"], r["_t"]) for r in dedupe.kept_times(times, micros).collect()} and len(got) > 100


def test_ttl_keeps_one_row_without_a_time(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("a", START, 3), (None, START, 4), (None, START, 5)], "key string, updated timestamp_ntz, n int")
    got = dedupe.dedupe_ttl(df, timedelta(days=1)).collect()
    assert sorted((str(r.key), str(r.updated)) for r in got) == [("None", str(START)), ("a", str(START)), ("a", "None")]


def test_ttl_ends_exactly_after_the_ttl(spark):
    rows = [("a", START), ("a", START + timedelta(days=1)), ("a", START + timedelta(days=1, hours=23))]
    df = spark.createDataFrame(rows, "key string, updated timestamp_ntz")
    assert sorted(r.updated for r in dedupe.dedupe_ttl(df, timedelta(days=1)).collect()) == [rows[0][1], rows[1][1]]


@pytest.mark.parametrize("cap, page, exact", [(7, 5, False), (7, 5, True), (250, 5, True)])
@pytest.mark.parametrize("group_limit", [1000, 3])
def test_limit_per_project_both_ways(spark, feed, cap, page, exact, group_limit):
    rows, df = feed
    name = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, group_limit)
    try:
        order = ("updated", "key", "source_path")
        got = {(r.project, r.position, r.n) for r in select.limit_per_project(df, cap, page, exact, order).collect()}
    finally:
        spark.conf.set(name, before)
    keep = cap if exact else 10
    want = set()
    for p in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == p), key=lambda r: (r[2], r[0], r[3]))[:keep]
        want |= {(p, i + 1, r[4]) for i, r in enumerate(mine)}
    assert got == want


def test_resume_and_since(spark):
    df = spark.createDataFrame(
        [("A", datetime(2024, 1, 5, 1)), ("A", datetime(2024, 1, 4, 23)), ("B", START)], "project string, updated timestamp_ntz")
    progress = spark.createDataFrame([("A", datetime(2024, 1, 5, 20))], "project string, last_update timestamp_ntz")
    assert {(r.project, r.updated) for r in select.resume(df, progress).collect()} == {
        ("A", datetime(2024, 1, 5, 1)), ("B", START)}
    assert select.updated_since(df, None).count() == 3
    projects = spark.createDataFrame([("A",), ("B",)], "project string")
    now = datetime(2024, 3, 1, 7)
    since = lambda start: {r.project: r.since for r in select.resolve_since(projects, progress, start, now).collect()}
    assert since(None) == since("") == {"A": datetime(2024, 1, 5, 20), "B": None}
    assert since("2024-02-03") == {"A": datetime(2024, 2, 3), "B": datetime(2024, 2, 3)}
    assert since("03.02.2024") == since("2024-02-31") == {"A": datetime(2024, 1, 31, 7), "B": datetime(2024, 1, 31, 7)}
    assert select.filter_projects(df, ["B"]).count() == 1 and select.filter_projects(df, []).count() == 3


def test_progress_is_a_maximum_and_skips_blank_projects(spark):
    df = spark.createDataFrame([("A", START), (" ", START), (None, START), ("B", START)], "project string, updated timestamp_ntz")
    old = spark.createDataFrame([("A", START + timedelta(1)), ("B", START - timedelta(1))], "project string, last_update timestamp_ntz")
    got = {r.project: r.last_update for r in metrics.last_update_by_project(df, old).collect()}
    assert got == {"A": START + timedelta(1), "B": START}


def test_search_pages_and_missing_offsets(spark):
    page = '{"issues":[{"key":"A-1"},{},{"key":""},{"key":"A-2"}],"total":170}'
    rows = [("A", 0, 200, page), ("A", 50, 500, page), ("A", 100, 200, "{"), ("A", 150, 200, page), ("B", 0, 200, '{"total":0}')]
    df = spark.createDataFrame(rows, "project string, start_at long, status int, body string")
    keys = parse_search_pages(df).filter("start_at = 0").collect()
    assert {(r.key, r.total, r.max_results) for r in keys} == {("A-1", 170, 50), ("A-2", 170, 50)}
    offsets = lambda **k: sorted(r.start_at for r in fetch.missing_pages(df, **k).collect())
    assert offsets() == [50, 100] and offsets(max_issues=60) == [50]
    small = [("C", 0, 200, '{"total":60,"maxResults":25}'), ("C", 50, 200, '{"total":60,"maxResults":25}'), ("D", 0, 500, None)]
    df = spark.createDataFrame(small, "project string, start_at long, status int, body string")
    assert {(r.project, r.start_at) for r in fetch.missing_pages(df).collect()} == {("C", 25), ("D", 0)}


def test_missing_ranges_of_mixed_pages(spark):
    def page(project, start, size, total, status=200):
        return (project, start, status, f'{{"total":{total},"maxResults":{size}}}' if status == 200 else None)

    rows = [page("A", 0, 10, 100), page("A", 10, 4, 100), page("A", 20, 30, 100), page("A", 30, 5, 100), page("A", 50, 25, 100, 500),
            page("A", 75, 50, 100), page("B", 0, 50, 40), page("C", 0, 50, 9, 500), page("D", 0, 50, 0), page("E", 10, 10, 20), page("E", 30, 10, 20)]
    df = spark.createDataFrame(rows, "project string, start_at long, status int, body string").repartition(3)
    got = lambda **k: sorted((r.project, r["first"], r["last"]) for r in fetch.missing_ranges(df, **k).collect())
    assert got() == [("A", 14, 19), ("A", 50, 74), ("C", 0, 0), ("E", 0, 9)]
    assert got(max_issues=17) == [("A", 14, 16), ("C", 0, 0), ("E", 0, 9)]
    many = [page("H", n * 10, 10, 30_000) for n in range(3000) if n % 500 != 7]
    hot = spark.createDataFrame(many, "project string, start_at long, status int, body string").repartition(5)
    assert sorted(r["first"] for r in fetch.missing_ranges(hot).collect()) == [70 + 5000 * n for n in range(6)]


def test_a_large_cap_fills_no_single_task(spark):
    marks = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"), F.timestamp_seconds(F.col("id") % 100).cast("timestamp_ntz").alias("processed_at"))
    capped = dedupe.append_processed(marks.limit(0), marks, cap=3020)
    text = capped._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in text and "SinglePartition" not in text
    got = sorted(((r.processed_at.timestamp(), r.key) for r in capped.collect()), key=lambda r: (-r[0], r[1]))
    want = sorted(((r.processed_at.timestamp(), r.key) for r in marks.collect()), key=lambda r: (-r[0], r[1]))[:3020]
    assert got == want


def test_retry_backlog(spark):
    rows = [
        ("u1", "A", 429, 0, "400", 1), ("u2", "A", 429, 2, "abc", 1), ("u3", "A", 503, 5, None, 1), ("u4", "A", 404, 0, None, 1),
        ("u5", "A", 500, 0, None, 1), ("u5", "A", 200, 1, None, 2), ("u6", None, None, 4, None, 1), ("u7", "A", 429, 1, " 12.5 ", 1),
        ("u8", "A", 503, 1, "99", 1)]
    df = spark.createDataFrame(rows, "url string, project string, status int, attempt int, retry_after string, n int").withColumn(
        "ts", F.timestamp_seconds("n").cast("timestamp_ntz"))
    got = {r.url: (r.action, r.delay_seconds) for r in fetch.retry_backlog(df).collect()}
    assert got == {"u1": ("retry", 300.0), "u2": ("retry", 4.0), "u3": ("give_up", None), "u6": ("retry", 16.0),
                   "u7": ("retry", 12.5), "u8": ("retry", 2.0)}
