import json

import pytest
from conftest import comment, issue, stored
from pyspark.sql import functions as F

from ticketloom.operators.metrics import validation_errors
from ticketloom.operators.validate import split_valid
from ticketloom.schema import ISSUE_SCHEMA, RULE_CODES
from ticketloom.sources.issues import parse_issue


def parsed(docs, items, shape="auto"):
    rows = parse_issue(docs(items), shape).orderBy(F.length("source_path"), "source_path").collect()
    return [r.asDict() for r in rows]


def codes(docs, item):
    return parsed(docs, [item])[0]["violations"]


def with_comments(*comments):
    return issue(comment={"comments": list(comments)})


CASES = [
    (issue(), []),
    (issue(summary=""), []),
    (issue(priority=..., status=..., reporter=..., issuetype=..., comment=..., project=...), []),
    (issue(assignee={"displayName": "Z"}, resolution={}, description=None), []),
    (with_comments(comment(author=...), comment(body=...), comment(updated=None)), []),
    ("{oops", ["bad_json"]),
    ("[1]", ["missing_key", "missing_fields"]),
    ({"fields": issue()["fields"]}, ["missing_key"]),
    ({**issue(), "key": 7}, ["missing_key"]),
    ({"key": "WEB-1"}, ["missing_fields"]),
    ({"key": "WEB-1", "fields": None}, ["missing_fields"]),
    (issue(project=None), ["null_container"]),
    (issue(comment=None), ["null_container"]),
    (issue(summary=...), ["summary"]),
    (issue(summary=None), ["summary"]),
    (issue(summary=123), ["summary"]),
    (issue(description=5), ["description"]),
    (issue(created=...), ["created"]),
    (issue(updated="soon"), ["updated"]),
    (issue(updated=None), ["updated"]),
    (issue(resolutiondate="soon"), ["resolutiondate"]),
    (issue(status=None), ["status"]),
    (issue(priority=None), ["priority"]),
    (issue(reporter="ann"), ["reporter"]),
    (issue(issuetype=None), ["issuetype"]),
    (issue(assignee="ann"), ["assignee"]),
    (issue(resolution=3), ["resolution"]),
    (with_comments(comment(author=None)), ["comment"]),
    (with_comments(comment(body=None)), ["comment"]),
    (with_comments(comment(body=4)), ["comment"]),
    (with_comments(comment(created=...)), ["comment"]),
    (with_comments(comment(updated="never")), ["comment"]),
    (with_comments(comment(), "text"), ["comment"]),
    (issue(comment={"comments": None}), ["comment"]),
    (issue("SOLO", project=...), ["no_project"]),
    (issue(summary=None, updated=...), ["summary", "updated"]),
    (stored(), []),
    (stored(issue_type=None), ["issuetype"]),
]


def test_rules(docs):
    got = [r["violations"] for r in parsed(docs, [c for c, _ in CASES])]
    assert got == [want for _, want in CASES]
    assert {c for codes_ in got for c in codes_} == set(RULE_CODES)


def test_schema_is_the_published_one(docs):
    df = parse_issue(docs([issue()]))
    types = {f.name: f.dataType for f in df.schema.fields}
    assert all(types[f.name].simpleString() == f.dataType.simpleString() for f in ISSUE_SCHEMA.fields)


def test_api_and_stored_shape(docs):
    api, kept = parsed(docs, [with_comments(comment("x"), comment("y", author={"name": "n"})), stored()])
    assert [(c["idx"], c["author"], c["body"]) for c in api["comments"]] == [(0, "Bob", "x"), (1, "Unknown", "y")]
    assert (api["project"], api["issue_type"], api["reporter"], api["has_assignee"]) == ("WEB", "Bug", "Ann", False)
    assert (kept["issue_type"], kept["comments"][0]["body"], str(kept["created"])) == ("Bug", "a patch", "2024-01-09 08:45:12")


def test_api_shape_loses_what_stored_files_keep_elsewhere(docs):
    (row,) = parsed(docs, [stored()], shape="api")
    assert (row["comments"], row["issue_type"], row["violations"]) == ([], "", [])


def test_project_fallbacks_and_number_ids(docs):
    rows = parsed(docs, [issue("A-B-1", project=...), stored("C-1", project=""), with_comments(comment(id=12))])
    assert [r["project"] for r in rows] == ["A", "C", "WEB"]
    assert rows[2]["comments"][0]["id"] == "12"


def test_split_keeps_the_raw_record_of_rejects(docs):
    bad = issue(summary=None)
    valid, invalid = split_valid(parse_issue(docs([issue(), bad, "{"])))
    assert valid.count() == 1
    assert sorted(r.value for r in invalid.collect()) == sorted([json.dumps(bad), "{"])


def test_strict_mode_fails_the_job(docs):
    valid, _ = split_valid(parse_issue(docs([issue(), issue("WEB-2", summary=None)])), strict=True)
    with pytest.raises(Exception, match="invalid issue WEB-2: summary"):
        valid.collect()


def test_errors_count_for_the_stated_project(docs):
    rows = validation_errors(parse_issue(docs([
        issue(summary=None), issue("WEB-2", summary=None, updated=None), issue("X-1", project=..., status=None), "{"])))
    assert {(r.project, r.error_type, r.n_errors) for r in rows.collect()} == {
        ("WEB", "summary", 2), ("WEB", "updated", 1), ("unknown", "status", 1), ("unknown", "bad_json", 1)}


def test_repeated_names_and_nan_are_read_and_the_last_name_counts(docs):
    text = json.dumps(with_comments(comment(), comment(body="again")))
    twice = text.replace('"fields": {', '"key": "OLD-1", "key": "WEB-1", "fields": {"summary": 5, ')
    assert [r["violations"] for r in parsed(docs, [twice, " \n" + twice, twice[:-1]])] == [[], [], ["bad_json"]]
    deep = text.replace('"name": "Open"', '"name": "Old", "name": "Open"').replace('"body": ', '"body": null, "body": ')
    deep = deep.replace('"displayName": "Bob"', '"displayName": {"a": 1, "a": 2}, "displayName": "Bob"')
    got, plain = parsed(docs, [deep, text])
    assert {k: v for k, v in got.items() if k not in ("raw", "value", "source_path")} == {
        k: v for k, v in plain.items() if k not in ("raw", "value", "source_path")}
    assert got["status"] == "Open" and [c["body"] for c in got["comments"]] == ["Fixed it", "again"]
    # a container that holds repeated names keeps its faults, and a missing attribute stays missing
    odd = json.dumps(issue(status=..., priority=None, comment={"comments": [None, "text", 5]})).replace('"created":', '"created": 1, "created":')
    assert codes(docs, odd.replace('"name": "ann"', '"name": "x", "name": "ann"')) == ["priority", "comment"]


def test_nan_is_a_number(docs):
    text = json.dumps(issue())
    assert codes(docs, text.replace('"Broken link"', "NaN")) == ["summary"]
    assert codes(docs, text.replace('"Broken link"', "-Infinity")) == ["summary"]
    assert codes(docs, text.replace('"key": "Urgent"', '"x": NaN, "key": "Urgent"').replace("{", '{"n": NaN, ', 1)) == []
    late = text.replace('"created":', '"created": NaN, "created":').replace('"key": "WEB-1", ', "")[:-1] + ', "key": "WEB-1"}'
    assert codes(docs, late) == []
    # the strict parser ignores what follows a document, the second reader does not
    assert [codes(docs, late + end) for end in (" x", "]", ", {}", "], [1")] == [["bad_json"]] * 4
    assert codes(docs, "{'key': 'WEB-1'}") == ["bad_json"] and codes(docs, '{"a": NaN} {}') == ["bad_json"]
