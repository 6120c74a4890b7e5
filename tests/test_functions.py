import html
import random
import re
from datetime import datetime, timezone
from html.entities import html5

from pyspark.sql import functions as F

from ticketloom.functions.names import project_from_key, project_from_object_key, project_from_path, project_from_url
from ticketloom.functions.text import (
    clean_text, clean_texts, contains_resolution_keywords, join_nonblank, strip_ends, truncate,
)
from ticketloom.functions.times import iso_format, parse_ts, stored_format


def column(spark, values, expr, schema="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {schema}")
    rows = df.select("i", expr(F.col("v")).alias("out")).collect()
    return [r.out for r in sorted(rows, key=lambda r: r.i)]


def plain_clean(text):
    return " ".join(html.unescape(re.sub("<[^>]+>", "", text or "")).split())


EDGE_TEXTS = [
    None, "", "&", "&&amp;", "&amp;lt;", "&lt;b&gt;", "&ampfoo", "&notit;", "&notin;", "&#8217;x", "&#x1F600;", "&#0;",
    "&#128;y", "&#x81;", "&#xD800;", "&#99999999999;", "&#;", "&#xg", "&#1;a", "&#11;", "&#xfdd0;z", "&#13;q",
    "a < b > c", "<b\nx>y", "x\u00a0\u2003\x1c\x85 y\u200bz", "  a  \n\n b  ", "&fjlig;", "&AMP", "&am", "&copy 2020",
    "<>", "<<a>>", "&\U0001F600;", "&#0000000000065;", "&lt&gt", "no tag", "<unclosed", "a=1&b=2",
]


def test_clean_text_equals_the_stdlib_on_edges_and_random_text(spark):
    rnd = random.Random(7)
    names = list(html5)
    parts = [
        lambda: "&" + rnd.choice(names), lambda: "&" + rnd.choice(names)[:-1],
        lambda: f"&#{rnd.randint(0, 1200000)};", lambda: f"&#x{rnd.randint(0, 1200000):x}",
        lambda: rnd.choice([" ", "\n", "\t", "\u3000", "\x1f", "<i>", "</p>", "<", "x", "é", "&", "#", ";", "\x0b"])]
    texts = EDGE_TEXTS + ["".join(rnd.choice(parts)() for _ in range(rnd.randint(1, 6))) for _ in range(1500)]
    assert column(spark, texts, clean_text) == [plain_clean(t) for t in texts]


def test_clean_text_over_whole_documents_and_pages(spark):
    for name, col in (("pages", "html"), ("documents", "text")):
        rows = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").select(
            col, clean_text(F.col(col)).alias("clean")).collect()
        assert all(r.clean == plain_clean(r[col]) for r in rows)


def test_clean_texts_cleans_each_element(spark):
    out = column(spark, [["<b>a</b>", None, "&lt;"], []], clean_texts, "array<string>")
    assert out == [["a", "", "<"], []]


def test_truncate_counts_code_points(spark):
    text = "x" * 1999 + "\U0001F600" + "tail"
    assert column(spark, [text], lambda c: truncate(c, 2000)) == [text[:2000]]


def test_join_and_strip(spark):
    df = spark.createDataFrame([("a", "", None, "d")], "a string, b string, c string, d string")
    assert df.select(join_nonblank(" | ", *[F.col(c) for c in "abcd"])).first()[0] == "a | d"
    assert column(spark, ["\n\nComments:\n", " \n"], strip_ends) == ["Comments:", ""]


def test_keywords_are_substrings_of_the_raw_body(spark):
    bodies = ["a problem", "FIXED", "<patch>", "nothing", None, "Pull Request 7", "solutıon"]
    assert column(spark, bodies, contains_resolution_keywords) == [True, True, True, False, False, True, False]
    assert column(spark, ["done", "fix"], lambda c: contains_resolution_keywords(c, ["done"])) == [True, False]


def as_utc(text):
    try:
        at = datetime.fromisoformat(text.replace("+0000", "+00:00"))
    except ValueError:
        return None
    return at if at.tzinfo is None else at.astimezone(timezone.utc).replace(tzinfo=None)


TIMES = [
    "2024-01-15T10:30:00.000+0000", "2006-04-20 00:59:20+00:00", "2024-01-15T10:30:00Z", "2024-01-15T10:30:00",
    "2024-01-15T10:30:00.123456+05:30", "2024-01-15T10:30:00.1234567Z", "2024-01-15", "20240115", "2024-01-15T10",
    "2024-01-15T10:30", "20240115T103000", "20240115T103000+0100", "2024-01-15T10:30:00-08", "2024-01-15x10:30:00",
    "2024-02-30T10:30:00Z", "2024-13-01", "2024", "2024-1-5", "yesterday", "", "2024-01-15T24:30:00", "0000-01-01",
    "2024-01-15T10:60:00", " 2024-01-15", "2024-01-15T10:30:00,5Z", "now", "12:30:00",
]


def test_parse_ts_accepts_what_iso_8601_allows(spark):
    assert column(spark, TIMES, parse_ts) == [as_utc(t) for t in TIMES]


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        texts = ["2024-03-10T02:30:00.000+0000", "2024-11-03 05:30:00.25+00:00"]
        assert column(spark, texts, lambda c: iso_format(parse_ts(c))) == [
            "2024-03-10T02:30:00+00:00", "2024-11-03T05:30:00.250000+00:00"]
        assert column(spark, texts[:1], lambda c: stored_format(parse_ts(c))) == ["2024-03-10 02:30:00+00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_project_names(spark):
    assert column(spark, ["A-B-1", "AB1", None], project_from_key) == ["A", None, None]
    urls = ["https://x.org/rest/api/2/issue/WEB-12", "https://x.org/9-a/b", "https://my-host.org/a/WEB-1", "é-x"]
    assert column(spark, urls, project_from_url) == ["WEB", None, "my", "é"]
    paths = ["file:/d/raw/WEB/WEB-1.json", "file:/d/raw/WEB-1.x.json", "file:/d/raw/one.json", "file:/d/raw/project=P/a.json"]
    assert column(spark, paths, lambda c: project_from_path(c, "file:/d/raw/")) == ["WEB", "WEB", None, "P"]
    keys = ["s3a://bucket/raw/WEB/WEB-1.json", "s3a://bucket/WEB-1.json"]
    assert column(spark, keys, project_from_object_key) == ["WEB", None]
