"""The builders against a second statement of their text rules in plain Python."""

import json
import random

from conftest import comment, issue
from pyspark.sql import functions as F
from test_functions import plain_clean

from ticketloom.operators import tasks
from ticketloom.operators.comments import resolution_comments
from ticketloom.operators.select import has_content
from ticketloom.sources.issues import parse_issue

WORDS = ["fix", "patch", "solution", "pull request", "hello", "", " ", "<b>fix</b>", "<fix>", "a & b", "&lt;x&gt;", "é\u00a0z"]


def random_issue(rnd, n):
    name = lambda *options: rnd.choice([{"name": o} for o in options] + [{}])
    comments = [
        comment(" ".join(rnd.choices(WORDS, k=rnd.randint(0, 4))), f"2024-01-{rnd.randint(1, 5):02d}T00:00:00.000+0000")
        for _ in range(rnd.choice([0, 0, 1, 3, 7]))]
    return issue(
        f"WEB-{n}", summary=rnd.choice(["", "Crash", "It's slow"]),
        description=rnd.choice([None, "", " ", "<br>", "text " * rnd.choice([1, 900]), "<p>a</p>\n&amp;"]),
        status=name("Open", "", "Closed"), priority=name("High", ""), issuetype=name("Bug", ""),
        resolution=rnd.choice([None, {}, {"name": "Fixed"}, {"name": "Unresolved"}, {"name": ""}]),
        assignee=rnd.choice([None, {}, {"displayName": "Zoe"}, {"name": "z"}]),
        comment={"comments": comments})


def expected(doc):
    f = doc["fields"]
    summary, clean = f["summary"], plain_clean(f["description"])
    comments = f["comment"]["comments"]
    label = {k: (f[k] or {}).get("name", "") for k in ("status", "priority", "issuetype", "resolution")}
    hits = [c for c in comments if any(w in c["body"].lower() for w in
            ("fix", "patch", "cause", "pr", "pull request", "solution", "resolved"))]
    hits = [plain_clean(c["body"]) for c in sorted(hits, key=lambda c: c["created"], reverse=True)]
    title = summary or "Issue " + doc["key"]

    head = [f"Title: {summary}"] * bool(summary) + [f"Description: {clean}"] * bool(f["description"])
    tags = [f"{n}: {label[k]}" for n, k in (("Status", "status"), ("Type", "issuetype"), ("Priority", "priority")) if label[k]]
    head += [" | ".join(tags)] * bool(tags)
    if not hits:
        known = f["resolution"] and label["resolution"] and label["resolution"].lower() != "unresolved"
        response = f"Resolution: {label['resolution']}" if known else "No resolution information available."
    else:
        response = "\n\n---\n\n".join(b for b in hits[:3] if b) or "No resolution comments found."
    first = "\n\n".join(plain_clean(c["body"]) for c in comments[:5])
    classes = [f"{n}: {label[k]}" for n, k in (
        ("Type", "issuetype"), ("Priority", "priority"), ("Status", "status"), ("Resolution", "resolution")) if label[k]]
    context = f"Title: {title}" + (f"\n\nDescription: {clean}" if clean else "")
    if hits:
        answer = "\n\n".join(hits[:2])
    elif f["resolution"]:
        answer = "The issue was resolved as: " + label["resolution"]
    else:
        answer = "The issue status and resolution details are not available."
    return {
        "instruction": "\n\n".join(head) or "Issue: " + doc["key"],
        "response": response,
        "summarization": {
            "task": "summarization", "input": f"{clean}\n\nComments:\n{first}".strip()[:2000],
            "output": title + (f" - Resolved: {label['resolution']}" if label["resolution"] else "")},
        "classification": {
            "task": "classification", "input": f"Title: {summary}\n\nDescription: {clean}".strip()[:2000],
            "output": " | ".join(classes) or "Unclassified"},
        "qa": {"task": "qa", "question": f"What is the issue with '{title}' and how was it resolved?",
               "context": context[:2000], "answer": answer[:1000]},
    }


def test_random_issues(docs):
    rnd = random.Random(3)
    items = [random_issue(rnd, n) for n in range(300)]
    prepared = tasks.prepare(parse_issue(docs(items)))
    rows = prepared.select(
        "key", tasks.instruction().alias("instruction"), tasks.response().alias("response"),
        F.to_json(tasks.summarization()).alias("s"), F.to_json(tasks.classification()).alias("c"),
        F.to_json(tasks.qa()).alias("q")).collect()
    got = {r.key: {"instruction": r.instruction, "response": r.response, "summarization": json.loads(r.s),
                   "classification": json.loads(r.c), "qa": json.loads(r.q)} for r in rows}
    for doc in items:
        assert got[doc["key"]] == expected(doc)

    kept = {r.key for r in has_content(prepared).select("key").collect()}
    assert kept == {d["key"] for d in items if plain_clean(d["fields"]["description"]) or d["fields"]["comment"]["comments"]}


def test_all_tasks_metadata(docs):
    doc = issue(assignee={"displayName": "Zoe"}, comment={"comments": [comment("<i>ok</i>")]})
    line = json.loads(tasks.all_tasks(tasks.prepare(parse_issue(docs([doc])))).select(F.to_json(F.struct("*"))).first()[0])
    assert line["metadata"] == {
        "issue_key": "WEB-1", "project": "WEB", "title": "Broken link", "status": "Open", "priority": "Urgent",
        "reporter": "Ann", "created": "2024-01-09T08:45:12+00:00", "updated": "2024-01-11T17:20:33+00:00",
        "assignee": "Zoe"}
    assert line["comments"] == [{"author": "Bob", "body": "ok", "created": "2024-01-16T08:00:00+00:00"}]
    assert list(line["tasks"]) == ["summarization", "classification", "qa"]


def test_alpaca_overrides(docs):
    prepared = tasks.prepare(parse_issue(docs([issue(), issue("WEB-2")])))
    override = F.when(F.col("key") == "WEB-2", "Say it")
    rows = {r.key: r for r in tasks.alpaca(
        prepared, override, tasks.response(F.array(F.lit("<b>one</b>"), F.lit(" "))), keep=("key",)).collect()}
    assert rows["WEB-2"].instruction == "Say it" and rows["WEB-1"].instruction.startswith("Title: Broken link")
    assert rows["WEB-1"].response == "one" and rows["WEB-1"].input == ""


def test_resolution_comments_newest_first_and_stable(docs):
    same = "2024-01-02T00:00:00.000+0000"
    items = [comment("fix a", same), comment("no", same), comment("fix b", same), comment("fix c", "2024-01-03T00:00:00Z"),
             comment("fix d", "2024-01-01T00:00:00Z")]
    df = parse_issue(docs([issue(comment={"comments": items})]))
    bodies = lambda k: [c.body for c in df.select(resolution_comments(F.col("comments"), k)).first()[0]]
    assert bodies(3) == ["fix c", "fix a", "fix b"]
    assert bodies(None) == ["fix c", "fix a", "fix b", "fix d"]
