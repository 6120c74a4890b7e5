"""WARC derivatives: metadata and plain-text records from responses, linked back to them.

Every response gives a ``metadata`` record (JSON about the response: its identifier, target, date, digests,
HTTP status and headers, title, links) and a ``conversion`` record (its visible text). Both refer to
the response by WARC-Refers-To, keep its target and date, and carry digests of their own blocks. Records are
rows; files are written and read as text that Spark splits at record borders.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import table
from llm.extract import _NOTHING, Node, Said, TreeBuilder, blocks

VERSION = "WARC/1.1"
#: Date of records whose source states none.
NO_DATE = "1970-01-01T00:00:00Z"
_HIDDEN = frozenset("head title script style noscript template".split())
SCHEMA = ("record_type string, record_id string, refers_to string, target_uri string, date string, content_type string, "
          "content_length long, block_digest string, source_digest string, header string, block string")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_uuid(*parts: str) -> str:
    """An identifier that depends on its parts alone, so that a task that runs again gives it again."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(10).join(parts))}>"


def header_of(kind: str, fields: list[tuple[str, str]]) -> str:
    """The header of a record, up to and with the empty line. Line breaks inside a value become spaces."""
    lines = [VERSION, f"WARC-Type: {kind}"]
    lines += [f"{k}: {' '.join(v.splitlines())}" for k, v in fields if v]
    return "\r\n".join(lines) + "\r\n\r\n"


def split_response(block: str) -> tuple[str, list[tuple[str, str]], str]:
    """An HTTP response -> status line, headers, body. A block without a status line is a body alone."""
    if not block.startswith("HTTP/"):
        return "", [], block
    head, gap, body = block.partition("\r\n\r\n")
    if not gap:
        head, gap, body = block.partition("\n\n")
    status, *lines = head.splitlines()
    headers = [(k.strip(), v.strip()) for k, sep, v in (line.partition(":") for line in lines) if sep]
    return status, headers, body


class _LinkedTree(TreeBuilder):
    """A tree that also lists the links of the page."""

    def __init__(self):
        super().__init__()
        self.links: list[str] = []

        self.title: Node | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "a":
            self.links += [v for k, v in attrs if k == "href" and v]
        super().handle_starttag(tag, attrs)
        if tag == "title" and self.title is None:
            self.title = self.at

    def stated(self, attrs: list) -> Said:
        return _NOTHING  # what counts here is the element alone

    def surrounds(self, tag: str, attrs: list) -> bool:
        return tag in _HIDDEN


def page_parts(html: str) -> tuple[str, list[str], str]:
    """Title, links in page order and visible text (menus and the like included) of a page."""
    builder = _LinkedTree()
    builder.feed(html)
    builder.close()
    title = "".join(x for x in builder.title.items if isinstance(x, str)) if builder.title else ""
    return " ".join(title.split()), builder.links, "\n".join(blocks(builder.root))


def derive(record_id: str | None, uri: str | None, date: str | None, content_type: str | None, block: str | None) -> list[tuple]:
    """The two records of one response, as rows of ``SCHEMA``."""
    block, uri, date = block or "", uri or "", date or NO_DATE
    record_id = record_id or record_uuid("response", uri, date, block)
    status, headers, body = split_response(block)
    kind = next((v for k, v in headers if k.lower() == "content-type"), "") or content_type or ""
    markup = not kind or "html" in kind or "xml" in kind
    title, links, text = page_parts(body) if markup else ("", [], body if kind.startswith("text/") else "")
    block_digest, payload_digest = digest(block.encode("utf-8", "replace")), digest(body.encode("utf-8", "replace"))
    meta = json.dumps({
        "envelope": {"warc-record-id": record_id, "warc-target-uri": uri, "warc-date": date,
                     "block-digest": block_digest, "payload-digest": payload_digest},
        "http": {"status": status, "headers": headers}, "html": {"title": title, "links": links}}, ensure_ascii=False)
    rows = []
    for name, mime, out in (("metadata", "application/json", meta), ("conversion", "text/plain", text)):
        data = out.encode("utf-8", "replace")
        own, stated = record_uuid(name, record_id), digest(data)
        header = header_of(name, [
            ("WARC-Record-ID", own), ("WARC-Refers-To", record_id), ("WARC-Target-URI", uri), ("WARC-Date", date),
            ("WARC-Block-Digest", stated), ("Content-Type", mime), ("Content-Length", str(len(data)))])
        rows.append((name, own, record_id, uri, date, mime, len(data), stated, payload_digest, header, out))
    return rows


def derivatives(responses: DataFrame) -> DataFrame:
    """``record_id, target_uri, date, content_type, block`` and other columns -> two rows of ``SCHEMA`` per response.

    Null ids are made from the content, null dates become NO_DATE, null blocks are empty: no response is
    left out, and repeated rows give repeated records. Other columns are dropped.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                rows = [r for one in zip(*(c.to_pylist() for c in batch.slice(at, 64).columns), strict=True) for r in derive(*one)]
                columns = zip(*rows, strict=True) if rows else [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(
                    c, pa.int64() if n == "content_length" else pa.string()) for n, c in zip(names, columns, strict=True)], names=names)

    return responses.select("record_id", "target_uri", "date", "content_type", "block").mapInArrow(run, SCHEMA)


def write_warc(records: DataFrame, path: str, compression: str | None = None) -> None:
    """Records (``header, block``) as WARC files, one per partition. A record ends with two empty lines' breaks."""
    lines = records.select(F.concat("header", "block", F.lit("\r\n\r")).alias("value"))
    lines.write.option("lineSep", "\n").option("compression", compression or "none").text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """WARC files -> record_type, record_id, refers_to, target_uri, date, content_type, content_length, block, whole.

    Files are split at the border between records, so that a large one is read by many tasks. ``whole`` is
    false where the block does not have its stated length, as when a page contains such a border itself.
    """
    border = f"\r\n\r\n{VERSION}\r\n"
    raw = spark.read.option("lineSep", border).text(path)
    rows = raw.where("value <> ''").select(F.regexp_replace("value", f"^{VERSION}\r\n", "").alias("v")).select(
        F.substring_index("v", "\r\n\r\n", 1).alias("h"), "v").select("h", F.expr("substring(v, length(h) + 5)").alias("b"))
    # the last record of a file keeps its own end
    rows = rows.withColumn("b", F.regexp_replace("b", "\r\n\r\n$", ""))
    field = lambda name: F.nullif(F.regexp_extract("h", rf"(?im)^{name}:[ \t]*(.*?)\r?$", 1), F.lit(""))
    length = field("Content-Length").cast("long")
    return rows.select(
        field("WARC-Type").alias("record_type"), field("WARC-Record-ID").alias("record_id"),
        field("WARC-Refers-To").alias("refers_to"), field("WARC-Target-URI").alias("target_uri"),
        field("WARC-Date").alias("date"), field("Content-Type").alias("content_type"), length.alias("content_length"),
        F.col("b").alias("block"), (F.octet_length("b") == length).alias("whole"))


def page_responses(pages: DataFrame) -> DataFrame:
    """``page_id, url, html`` -> response records, with an HTTP head around the page."""
    body = F.coalesce("html", F.lit(""))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    name = F.sha1(F.concat_ws("\n", F.lit("page"), F.col("page_id").cast("string"), "url"))
    ident = F.concat(F.lit("<urn:uuid:"), F.regexp_replace(
        F.substring(name, 1, 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))
    return pages.select(
        ident.alias("record_id"), F.col("url").alias("target_uri"), F.lit(NO_DATE).alias("date"),
        F.lit("application/http; msgtype=response").alias("content_type"), F.concat(head, body).alias("block"))


def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both derivatives of every page."""
    return derivatives(page_responses(table(spark, sf_dir, "pages")))
