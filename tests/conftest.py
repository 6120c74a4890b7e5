import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ticketloom.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    conf = {"spark.checkpoint.dir": f"file://{folder}", "spark.sql.shuffle.partitions": "4"}
    session = local_session("8", "tests", **conf)
    yield session
    session.stop()


def issue(key="WEB-1", **fields):
    """A document of the tracker's shape; ``fields`` replace, and ``...`` removes, an attribute."""
    base = {
        "project": {"key": key.split("-")[0]}, "summary": "Broken link", "description": "<p>Page &amp; link</p>",
        "created": "2024-01-09T08:45:12.000+0000", "updated": "2024-01-11T17:20:33.000+0000",
        "resolutiondate": None, "status": {"name": "Open"}, "priority": {"name": "Urgent"},
        "assignee": None, "reporter": {"name": "ann", "displayName": "Ann"}, "issuetype": {"name": "Bug"},
        "resolution": None, "comment": {"comments": []},
    }
    base.update(fields)
    return {"key": key, "fields": {k: v for k, v in base.items() if v is not ...}}


def comment(body="Fixed it", created="2024-01-16T08:00:00.000+0000", **more):
    out = {"id": "1", "author": {"name": "bob", "displayName": "Bob"}, "body": body, "created": created, **more}
    return {k: v for k, v in out.items() if v is not ...}


def stored(key="WEB-1", project="WEB", **fields):
    """A document of the stored shape."""
    base = {
        "summary": "Broken link", "description": None, "created": "2024-01-09 08:45:12+00:00",
        "updated": "2024-01-11 17:20:33+00:00", "status": {"name": "Open"}, "priority": {"name": "Urgent"},
        "assignee": None, "reporter": {"displayName": "Ann"}, "issue_type": {"name": "Bug"}, "resolution": None,
        "resolutiondate": None, "comments": None,
    }
    base.update(fields)
    return {"key": key, "project": project, "fields": base,
            "comments": [{"id": "7", "author": {"displayName": "Bob"}, "body": "a patch",
                          "created": "2024-01-16 08:00:00+00:00", "updated": None}]}


@pytest.fixture
def docs(spark):
    """Python documents -> ``value, source_path`` rows."""
    def make(items):
        rows = [(item if isinstance(item, str) else json.dumps(item), f"doc/{i}") for i, item in enumerate(items)]
        return spark.createDataFrame(rows, "value string, source_path string")
    return make
