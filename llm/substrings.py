"""Substring dedup: passages of ``WINDOW`` words that a smaller document has, found by FM-indexes of shards.

A window is ``WINDOW`` consecutive words of one document. It is removed where its words also start in a
document with a smaller id; judged on the input. Equal windows have the same seed, the least hash of the
runs of ``SEED`` words in them, so a shard is all passages of some seeds, and no window has to look into
another shard:

1. Every document names its seeds, each with the windows that have it. Seeds of a single document are dropped.
2. The windows that are left are cut out as passages. Equal passages are one, of their smallest document.
3. A shard's passages make an FM-index; backward search over its wavelet matrix tells for every window of
   every passage the smallest document that has it.
4. The places of a passage in the documents take over what was found, and the words covered are removed.

A seed with more than ``HOT`` different passages (a frequent sentence in ever new surroundings) is split down to
single windows, which are counted by their hash, so that a shard stays bounded. Documents are known by id and
text: rows that repeat both are treated alike. Ids that are null are neither smaller nor larger than others: such
documents stay whole. Null texts have no words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import WORD, mix64, table
from llm.fm_index import FMIndex
from ticketloom.session import written

WINDOW, SEED = 50, 8
#: Windows of one passage at most; a longer run of windows is cut into several passages.
PASSAGE = 64
#: Different passages of a seed above which its windows are counted one by one.
HOT = 1024
#: Words of one index, and of the passages that one task should hold, on average.
SHARD_WORDS, TASK_WORDS = 1_000_000, 2_000_000
#: Entries that a task remembers of words and of passages it has sent.
REMEMBERED = 1_000_000


class _Hashes(dict):
    """64 bits of a word, remembered while there is room."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


_HASHES = _Hashes()


def seeds(words: list[str], window: int = WINDOW, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seeds of a text's windows: value, first window and window after the last, per run of windows that share it."""
    if len(words) < window:
        none = np.empty(0, np.int64)
        return none, none, none
    seed = min(seed, window)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    grams = np.zeros(len(words) - seed + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(seed):
            grams = grams * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + len(grams)]
    least, size, span = mix64(grams), 1, window - seed + 1
    while size * 2 <= span:
        least, size = np.minimum(least[:-size], least[size:]), size * 2
    if size < span:
        least = np.minimum(least[:size - span], least[span - size:])
    first = np.concatenate([[0], np.flatnonzero(np.diff(least)) + 1])
    return least[first].view(np.int64), first, np.append(first[1:], len(least))


def _naming(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, texts = (batch.column(n).to_pylist() for n in ("doc_id", "key", "text"))
            found, runs = [], []
            for row, text in enumerate(texts):
                runs.append(seeds(WORD.findall(text or ""), window))
                found.append(np.full(len(runs[-1][0]), row))
            if not found:
                continue
            row = np.concatenate(found)
            seed, first, last = (np.concatenate([r[k] for r in runs]) for k in range(3))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(ids, np.int64)[row]), pa.array(np.array(keys, np.int64)[row]), pa.array(seed.astype(np.int64)),
                 pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))], ["doc_id", "key", "seed", "first", "last"])
    return run


_PARTS = pa.schema([
    ("doc_id", pa.int64()), ("key", pa.int64()), ("n_words", pa.int64()), ("text", pa.string()), ("passage", pa.binary()),
    ("seed", pa.int64()), ("start", pa.int32()), ("size", pa.int32()), ("kind", pa.string())])


def _cutting(window: int, digest: bool):
    """Documents with their shared seeds -> the finished ones (nothing shared), the texts of the others, and passages.

    The words of a passage are sent once per task, as far as it remembers; its places always.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()
        for batch in batches:
            rows = []
            for doc, key, text, runs in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "key", "text", "runs")), strict=True):
                words = WORD.findall(text or "")
                if not runs:
                    rows.append((doc, key, len(words), _output(words, digest), None, None, None, None, "done"))
                    continue
                rows.append((doc, key, len(words), text, None, None, None, None, "open"))
                for run in runs:
                    for first in range(run["first"], run["last"], PASSAGE):
                        end = min(run["last"], first + PASSAGE) + window - 1
                        passage = " ".join(words[first:end])
                        name = xxhash.xxh3_128_digest(passage.encode("utf-8", "surrogatepass"))
                        if name in sent:
                            passage = None
                        elif len(sent) >= REMEMBERED:
                            sent.clear()
                        sent.add(name)
                        rows.append((doc, key, None, passage, name, run["seed"], first, end - first, "passage"))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_PARTS)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PARTS.types, strict=True)], schema=_PARTS)
    return run


def _output(words: list[str], digest: bool) -> str:
    kept = " ".join(words)
    return hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest() if digest else kept


def _spans(starts: np.ndarray, length: int) -> list[dict]:
    """Places ``length`` long from each of the ascending starts, merged."""
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > length) + 1
    return [{"a": int(part[0]), "b": int(part[-1]) + length} for part in np.split(starts, breaks)]


_FOUND = pa.schema([("passage", pa.binary()), ("spans", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))])


def _searching(window: int):
    """Passages of some shards -> those of which a smaller document has windows, with the words these cover."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        smallest: dict[bytes, tuple[int, int]] = {}
        texts: dict[bytes, str] = {}
        for batch in batches:
            for name, seed, doc, text in zip(*(batch.column(n).to_pylist() for n in ("passage", "seed", "doc_id", "text")), strict=True):
                if text is None:
                    smallest[name] = (seed, doc)
                else:
                    texts[name] = text
        n_shards = 1 + sum(len(t) for t in texts.values()) // (5 * SHARD_WORDS)
        shards: list[list[bytes]] = [[] for _ in range(n_shards)]
        for name, (seed, _) in smallest.items():
            shards[int(mix64(np.array([seed]).view(np.uint64))[0] % np.uint64(n_shards))].append(name)
        for names in shards:
            if not names:
                continue
            numbers: dict[str, int] = {}
            passages = [np.array([numbers.setdefault(w, len(numbers)) for w in texts[n].split(" ")]) for n in names]
            own = np.array([smallest[n][1] for n in names])
            found = FMIndex(passages, own, len(numbers), window).smallest_documents(passages)
            rows = [(n, _spans(np.flatnonzero(least < doc), window)) for n, least, doc in zip(names, found, own, strict=True)]
            names_, spans = zip(*[r for r in rows if r[1]] or [(None, None)], strict=True)
            if names_[0] is not None:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((names_, spans), _FOUND.types, strict=True)], schema=_FOUND)
    return run


def _windows(window: int):
    """Passages -> a 128-bit name and the place of each of their windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, doc, text in zip(*(batch.column(n).to_pylist() for n in ("passage", "doc_id", "text")), strict=True):
                words = text.split(" ")
                for i in range(len(words) - window + 1):
                    rows.append((xxhash.xxh3_128_digest(" ".join(words[i:i + window]).encode("utf-8", "surrogatepass")), name, doc, i))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.binary(), pa.int64(), pa.int32()), strict=True)],
                ["window", "passage", "doc_id", "at"])
    return run


def _removing(window: int, digest: bool):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, spans in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "text", "spans")), strict=True):
                words = WORD.findall(text)
                stays = np.ones(len(words), bool)
                for span in spans or []:
                    stays[span["a"]:span["b"]] = False
                kept = words if stays.all() else [words[i] for i in np.flatnonzero(stays)]
                rows.append((doc, len(words), len(words) - len(kept), _output(kept, digest)))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)
    return run


def covered_spans(passages: DataFrame, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """Passages (``passage, seed, doc_id, key, start, size``, some with ``text``) -> ``doc_id, key, spans`` of words to remove."""
    spark = passages.sparkSession
    least = written(passages.groupBy("passage").agg(F.min("doc_id").alias("doc_id"), F.min("seed").alias("seed")), "passages")
    texts = passages.where("text is not null").select("passage", "seed", "text", "size")
    hot_seeds = written(least.groupBy("seed").count().where(F.col("count") > hot).select("seed"), "hot-seeds")
    words = texts.agg(F.sum("size")).first()[0] or 0
    shards = max(spark.sparkContext.defaultParallelism, int(words) // TASK_WORDS + 1)
    both = least.select("passage", "seed", "doc_id", F.lit(None).cast("string").alias("text")).unionAll(
        texts.select("passage", "seed", F.lit(None).cast("long").alias("doc_id"), "text"))
    cold = both.join(hot_seeds, "seed", "left_anti").repartition(shards, "seed")
    found = cold.mapInArrow(_searching(window), "passage binary, spans array<struct<a:int,b:int>>")

    # hot seeds: one row per window and different passage, summed up before the shuffle
    split = texts.join(hot_seeds, "seed", "left_semi").join(least.select("passage", "doc_id"), "passage").select("passage", "doc_id", "text")
    windows = written(split.mapInArrow(_windows(window), "window binary, passage binary, doc_id long, at int"), "windows")
    first = windows.groupBy("window").agg(F.min("doc_id").alias("first"))
    later = windows.join(first, "window").where("first < doc_id").groupBy("passage").agg(
        F.transform(F.sort_array(F.collect_set("at")), lambda i: F.struct(i.alias("a"), (i + window).cast("int").alias("b"))).alias("spans"))
    found = written(found.unionAll(later), "found")

    # the smallest document of a passage loses what was found inside it, every other one all of it
    places = passages.select("passage", "doc_id", "key", "start", "size").join(
        least.select("passage", F.col("doc_id").alias("first")), "passage").join(found, "passage", "left")
    inside = F.transform("spans", lambda s: F.struct((s["a"] + F.col("start")).alias("a"), (s["b"] + F.col("start")).alias("b")))
    whole = F.array(F.struct(F.col("start").alias("a"), (F.col("start") + F.col("size")).alias("b")))
    spans = F.when(F.col("doc_id") > F.col("first"), whole).otherwise(inside)
    return places.withColumn("spans", spans).where("spans is not null").groupBy("doc_id", "key").agg(
        F.flatten(F.collect_set("spans")).alias("spans"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, digest: bool = False, hot: int = HOT) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, n_words, n_removed, kept``: the words left, joined by spaces (or their SHA-256)."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    known = keyed.where("doc_id is not null and text is not null")
    runs = written(known.mapInArrow(_naming(window), "doc_id long, key long, seed long, first int, last int"), "seeds")
    shared = runs.groupBy("seed").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("seed")
    marked = runs.join(shared, "seed").groupBy("doc_id", "key").agg(F.collect_set(F.struct("seed", "first", "last")).alias("runs"))
    parts = written(keyed.join(marked, ["doc_id", "key"], "left").mapInArrow(_cutting(window, digest), (
        "doc_id long, key long, n_words long, text string, passage binary, seed long, start int, size int, kind string")), "parts")
    done = parts.where("kind = 'done'").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("text").alias("kept"))
    spans = covered_spans(parts.where("kind = 'passage'").drop("kind", "n_words"), window, hot)
    rest = parts.where("kind = 'open'").select("doc_id", "key", "text").join(spans, ["doc_id", "key"], "left")
    return done.unionAll(rest.select("doc_id", "text", "spans").mapInArrow(
        _removing(window, digest), "doc_id long, n_words long, n_removed long, kept string"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the digest of the words it keeps."""
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), digest=True).select(
        "doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


ORACLE = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS ws FROM documents),
windows AS (
  SELECT r, doc_id, unnest(list_transform(range(1, greatest(len(ws) - 48, 1)), lambda p: struct_pack(
    p := p, h := md5(array_to_string(ws[p:p + 49], ' '))))) AS w FROM d),
least AS (SELECT w.h AS h, min(doc_id) AS first FROM windows GROUP BY 1),
later AS (
  SELECT DISTINCT r, unnest(range(w.p, w.p + 50)) AS pos FROM windows JOIN least ON least.h = w.h WHERE first < doc_id),
gone AS (SELECT r, list(pos) AS places, count(*) AS n FROM later GROUP BY 1)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(CASE WHEN n IS NULL THEN ws
    ELSE list_filter(ws, lambda x, i: NOT list_contains(places, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (r)
"""
