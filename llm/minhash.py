"""Near-duplicates by DartMinHash signatures and banded joining.

A text is a weighted set: its five-word shingles with their counts. For every shingle, darts fall on
the plane of weight and rank at one dart per unit of area, at places that only hashes of the shingle
decide. A text owns the darts below its shingles' weights. It looks at ranks up to ``theta``, chosen so
that enough darts fall, gives each dart to one of ``K`` coordinates and keeps the dart of least rank
per coordinate. Two texts keep the same dart with a probability that is their weighted Jaccard
similarity. Cost follows the number of shingles and darts, not their product.

Bands of ``ROWS`` coordinates give candidates. In each bucket all texts meet its smallest one; texts
of a bucket that this leaves in different groups are compared with each other in blocks. Signatures
rule out most candidates, and an exact comparison of the shingles decides the rest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType

from llm.common import WORD, content_key, mix64, table, unit
from llm.graph import components
from ticketloom.session import written

WIDTH, THRESHOLD = 5, 0.8
#: 36 bands of 6: at similarity 0.8 all bands miss with probability 2e-5, at 0.3 a pair meets with probability 0.03.
BANDS, ROWS = 36, 6
K = BANDS * ROWS
#: Of 216 coordinates, 173 agree on average at similarity 0.8; fewer than 146 do with probability 5e-6.
LEAST_EQUAL = 146
#: Texts and characters of one block of a bucket, on average; two blocks meet in one task at a time.
BLOCK, BLOCK_CHARS = 2048, 16_000_000
REMEMBERED = 400_000
#: Sketches that a task keeps for exact copies, about 600 bytes each.
REMEMBERED_TEXTS = 20_000
#: Cells of a text that are looked at in one step.
GRID = 2_000_000

_WORDS: dict[str, bytes] = {}


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of a text's shingles and their counts. A text of one to four words is one shingle; without words, none."""
    words = WORD.findall(text or "")
    if not words:
        return np.empty(0, np.uint64), np.empty(0)
    if len(_WORDS) > REMEMBERED:
        _WORDS.clear()
    ids = list(map(_WORDS.get, words))
    if None in ids:
        for w in {w for w, known in zip(words, ids, strict=True) if known is None}:
            _WORDS[w] = xxhash.xxh64_digest(w.encode("utf-8", "surrogatepass"))
        ids = map(_WORDS.__getitem__, words)
    hashes = np.frombuffer(b"".join(ids), dtype=">u8").astype(np.uint64)
    n = max(1, len(hashes) - WIDTH + 1)
    with np.errstate(over="ignore"):
        out = np.full(n, min(len(hashes), WIDTH), dtype=np.uint64)
        for i in range(min(len(hashes), WIDTH)):
            out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + n])
    values, counts = np.unique(out, return_counts=True)
    return values, counts.astype(float)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = float(np.minimum(a[1][i], b[1][j]).sum())
    total = float(a[1].sum() + b[1].sum()) - shared
    return shared / total if total else 0.0


_CUTS = np.array([0.0, 1 / 64])


def _rank_cuts(n: int) -> np.ndarray:
    """The first ``n`` + 1 cuts of the rank axis: 0, then from 1/64 on growing by half, then by one."""
    global _CUTS
    while len(_CUTS) <= n:
        more = [float(_CUTS[-1])]
        for _ in range(len(_CUTS)):
            more.append(more[-1] + min(1.0, more[-1] / 2))
        _CUTS = np.concatenate([_CUTS, more[1:]])
    return _CUTS[:n + 1]


def _darts(values: np.ndarray, weights: np.ndarray, cells: range) -> tuple[np.ndarray, np.ndarray]:
    """Ids and ranks of all darts below the weights in some cells of the rank axis.

    The weight axis is cut at 0, 1, 2, 4, 8, ..., and in equal steps where a cell would be above one unit of
    area. Cuts and darts depend on the element alone; a cell holds a Poisson number of darts.
    """
    cuts = _rank_cuts(cells.stop)
    ids, ranks, level, start, end = [], [], 0, 0.0, 1.0
    while True:
        inside = weights > start
        some, most = (values, weights) if inside.all() else (values[inside], weights[inside])
        if not len(some):
            break
        low, height = cuts[cells.start:-1], np.diff(cuts[cells.start:])
        steps = np.maximum(1, np.ceil((end - start) * height)).astype(np.int64)
        rank = np.repeat(np.arange(len(low)), steps)
        step = np.arange(len(rank)) - np.repeat(np.cumsum(steps) - steps, steps)
        width = (end - start) / steps[rank]
        area, first = width * height[rank], start + step * width
        code = mix64(mix64((rank + cells.start).astype(np.uint64) + np.uint64((level + 1) << 32)) + step.astype(np.uint64))
        none = np.exp(-area)
        least = (none * 2.0**64).astype(np.uint64)
        partial = bool((most < end).any())
        size = GRID // len(some) + 1
        for at in range(0, len(rank), size):  # bounded memory for any text
            seeds = mix64(some[:, None] + code[None, at:at + size])
            hit = seeds > least[at:at + size]
            if partial:
                hit &= first[at:at + size] < most[:, None]
            row, col = np.nonzero(hit)
            seeds, col = seeds[row, col], col + at
            u, p, a = unit(seeds), none[col], area[col]
            total, count, n = p, np.ones(len(col), dtype=np.int64), 1
            while True:
                p = p * a / n
                total = total + p
                more = u > total
                if n == 64 or not more.any():
                    break
                count += more
                n += 1
            dart = np.repeat(np.arange(len(col)), count)
            number = np.arange(len(dart)) - np.repeat(np.cumsum(count) - count, count)
            own, col = mix64(seeds[dart] + (number + 1).astype(np.uint64)), col[dart]
            if partial:
                good = first[col] + width[col] * unit(mix64(own + np.uint64(0x51ED27))) < most[row[dart]]
                own, col = own[good], col[good]
            ids.append(own)
            ranks.append(low[rank[col]] + height[rank[col]] * unit(mix64(own + np.uint64(0xC0FFEE))))
        level, start, end = level + 1, end, end * 2
    return np.concatenate(ids), np.concatenate(ranks)


def signature(values: np.ndarray, weights: np.ndarray, k: int = K) -> np.ndarray:
    """The dart of least rank per coordinate, as 64-bit ids. At least one element is needed."""
    # 14 % of the texts need a second look; what the first one finds does not depend on how far it goes
    theta = k * (math.log(k) + 2.0) / float(weights.sum())
    kept, best, done = np.zeros(k, dtype=np.uint64), np.full(k, np.inf), 0
    while np.isinf(best).any():  # a coordinate without a dart: look at higher ranks too
        while _rank_cuts(len(_CUTS) - 1)[-1] < theta:
            _rank_cuts(len(_CUTS))
        ahead = max(done + 1, int(np.searchsorted(_CUTS, theta)))
        ids, ranks = _darts(values, weights, range(done, ahead))
        slot = (ids % np.uint64(k)).astype(np.int64)
        np.minimum.at(best, slot, ranks)
        least = ranks == best[slot]
        kept[slot[least]] = ids[least]
        done, theta = ahead, theta * 1.2
    return kept


def band_keys(kept: np.ndarray, bands: int = BANDS) -> np.ndarray:
    rows = kept.reshape(bands, -1)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows.shape[1]):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return key.astype(np.int64)


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` -> a written table: row_id, doc_id, key (128 bits of the text), bands, sketch (a byte per coordinate).

    ``bands`` is empty for a text without words, which is a near-copy of nothing.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", content_key(F.col("text")).alias("key"), "text")
    schema = rows.drop("text").schema.add("bands", ArrayType(LongType())).add("sketch", BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: dict[bytes, tuple] = {}  # exact copies that a task meets again are sketched once
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                bands, bytes_ = [], []
                for key, text in zip(part.column("key").to_pylist(), part.column("text").to_pylist(), strict=True):
                    if len(done) > REMEMBERED_TEXTS:
                        done.clear()
                    if key not in done:
                        elements = shingles(text)
                        kept = signature(*elements) if len(elements[0]) else None
                        done[key] = ([], b"") if kept is None else (
                            band_keys(kept), (kept & np.uint64(255)).astype(np.uint8).tobytes())
                    bands.append(done[key][0])
                    bytes_.append(done[key][1])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(bands, pa.list_(pa.int64())), pa.array(bytes_, pa.binary())],
                    names=["row_id", "doc_id", "key", "bands", "sketch"])

    return written(rows.mapInArrow(run, schema), "minhash-sketches")


def _likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Candidate pairs ``a, b`` whose signatures agree often enough."""
    for side in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("node").alias(side), F.col("sketch").alias(f"s_{side}")), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x, y = (np.frombuffer(b"".join(part.column(s).to_pylist()), np.uint8).reshape(-1, K) for s in ("s_a", "s_b"))
                yield part.select(["a", "b"]).filter(pa.array((x == y).sum(axis=1) >= LEAST_EQUAL))

    return pairs.select("a", "b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def _linked(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """Those of the stored ``pairs`` whose texts reach the threshold, by their shingles themselves."""
    found = _texts_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), nodes, docs)
    full = pairs.join(found.select(F.col("node").alias("a"), F.col("text").alias("t_a")), "a").join(
        found.select(F.col("node").alias("b"), F.col("text").alias("t_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                good = []
                for b, x, y in zip(*(part.column(c).to_pylist() for c in ("b", "t_a", "t_b")), strict=True):
                    if last[0] != b:  # the pairs of a node come one after another
                        last = (b, shingles(y))
                    good.append(similarity(shingles(x), last[1]) >= threshold)
                yield part.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return written(full.select("a", "b", "t_a", "t_b").mapInArrow(run, "a long, b long"), "minhash-links")


def _texts_of(ends: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """``node`` -> node, text: each text looked up by its first document; only repeated rows can still give it twice."""
    wanted = nodes.select("node", "key", "doc_id").join(ends, "node")
    texts = docs.select("doc_id", "text", content_key(F.col("text")).alias("key"))
    same = (texts["key"] == wanted["key"]) & texts["doc_id"].eqNullSafe(wanted["doc_id"])
    return written(texts.join(wanted, same).select("node", "text").dropDuplicates(["node"]), "minhash-texts")


class Block:
    """The weighted shingles of many texts, to compare one with many of them exactly."""

    def __init__(self, texts: list[str]):
        sets = [shingles(t) for t in texts]
        self.starts = np.cumsum([0, *[len(v) for v, _ in sets]])
        values = np.concatenate([v for v, _ in sets])
        self.weights = np.concatenate([w for _, w in sets])
        known, self.ids = np.unique(values, return_inverse=True)
        self.totals = np.array([w.sum() for _, w in sets])
        self.own = np.zeros(len(known))

    def similar(self, i: int, to: np.ndarray) -> np.ndarray:
        """Weighted Jaccard similarity of text ``i`` with those of ``to``."""
        mine = slice(self.starts[i], self.starts[i + 1])
        self.own[self.ids[mine]] = self.weights[mine]
        shared = np.empty(len(to))
        for at in range(0, len(to), 64):
            some = to[at:at + 64]
            sizes = self.starts[some + 1] - self.starts[some]
            ends = np.cumsum(sizes)
            entries = np.arange(ends[-1]) + np.repeat(self.starts[some] - (ends - sizes), sizes)
            least = np.minimum(self.weights[entries], self.own[self.ids[entries]])
            shared[at:at + 64] = np.add.reduceat(least, ends - sizes)
        self.own[self.ids[mine]] = 0
        return shared / (self.totals[i] + self.totals[to] - shared)


def _across(buckets: DataFrame, nodes: DataFrame, docs: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """Links between texts that share a bucket and that no links connect yet, as a forest per pair of blocks.

    Every pair of a bucket's texts that the links so far leave apart is looked at, in blocks of bounded size;
    what comes out is at most one link per text and pair of blocks.
    """
    grouped = nodes.select("node", "sketch").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rows = buckets.select("band", "node").join(grouped.select("node", "root"), "node")
    mixed = rows.groupBy("band").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 <> r2").select("band")
    members = written(rows.join(mixed, "band"), "minhash-mixed")
    texts = _texts_of(members.select("node").distinct(), nodes, docs)
    sizes = members.join(texts.select("node", F.length("text").cast("long").alias("chars")), "node")
    blocks = sizes.groupBy("band").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("chars") / BLOCK_CHARS)).alias("blocks"))
    # buckets of one block share a group, as most are small; larger ones have a group per pair of blocks
    n, chars = sizes.agg(F.count(F.lit(1)), F.sum("chars")).first()
    together = max(1, n // BLOCK, (chars or 0) // BLOCK_CHARS)
    sides = members.join(blocks, "band").withColumn("block", F.pmod(F.xxhash64("node"), "blocks")).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "root",
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("band"), F.lit(together))).otherwise(F.col("band")).alias("group"),
        (F.col("blocks") == 1).alias("small"))
    full = sides.join(nodes.select("node", "sketch"), "node").join(texts, "node")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        cross = bool(group["i"].iloc[0] != group["j"].iloc[0])
        group = group.sort_values(["band", "node"], kind="stable")
        node, root, block = (group[c].to_numpy() for c in ("node", "root", "block"))
        sketch = np.frombuffer(b"".join(group["sketch"]), np.uint8).reshape(-1, K)
        band = group["band"].to_numpy()
        ends = np.append(np.flatnonzero(band[1:] != band[:-1]) + 1, len(band))
        likely: list[tuple[int, np.ndarray]] = []
        start = 0
        for end in ends.tolist():
            for k in range(start, end - 1):
                rest = np.arange(k + 1, end)
                apart = root[k + 1:end] != root[k]
                if cross:
                    apart &= block[k + 1:end] != block[k]
                rest = rest[apart]
                if len(rest):
                    rest = rest[(sketch[rest] == sketch[k]).sum(axis=1) >= LEAST_EQUAL]
                    if len(rest):
                        likely.append((k, rest))
            start = end
        a, b = [], []
        if likely:
            used = np.unique(node[np.concatenate([[k for k, _ in likely], *(r for _, r in likely)])])
            first = pd.Series(np.arange(len(node)), index=node).groupby(level=0).first()
            text = group["text"].to_numpy()
            exact = Block(text[first.loc[used].to_numpy()].tolist())
            label = {r: r for r in root.tolist()}  # union of roots, by path halving

            def top(r: int) -> int:
                while label[r] != r:
                    label[r] = r = label[label[r]]
                return r

            for k, rest in likely:
                rest = rest[[top(int(root[o])) != top(int(root[k])) for o in rest]]
                if len(rest):
                    near = exact.similar(int(np.searchsorted(used, node[k])), np.searchsorted(used, node[rest])) >= threshold
                    for other in rest[near].tolist():
                        x, y = top(int(root[other])), top(int(root[k]))
                        if x != y:
                            label[max(x, y)] = min(x, y)
                            a.append(node[k])
                            b.append(node[other])
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    return written(full.groupBy("small", "group", "i", "j").applyInPandas(compare, "a long, b long"), "minhash-links")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, text`` -> row_id, doc_id, key, class_id (smallest doc_id of the class) and kept (one row of each class).

    Classes are the texts that links of at least ``threshold`` connect, and their exact copies. Texts
    without words are near-copies of nothing, each row a class of its own. Among rows that share the
    smallest id of a class one is kept.
    """
    rows = sketches(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_id"))
    copies = rows.where(F.length("sketch") > 0).groupBy("key").agg(first.alias("f")).select(
        F.col("key"), F.col("f.row_id").alias("node"))
    nodes = written(rows.join(copies.select(F.col("node").alias("row_id")), "row_id").select(
        F.col("row_id").alias("node"), "doc_id", "key", "bands", "sketch"), "minhash-nodes")
    exploded = nodes.select("node", F.explode("bands").alias("band"))
    shared = exploded.groupBy("band").agg(F.min("node").alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = written(exploded.join(shared.select("band", "lead"), "band"), "minhash-buckets")
    pairs = buckets.where("node <> lead").select(F.col("node").alias("a"), F.col("lead").alias("b")).distinct()
    links = _linked(written(_likely(pairs, nodes), "minhash-pairs"), nodes, docs, threshold)
    roots = components(links)
    more = _across(buckets, nodes, docs, roots, threshold)
    if not more.isEmpty():
        roots = components(links.unionAll(more))
    # rows -> the node of their text -> its root; a row without words is its own
    owned = rows.select("row_id", "doc_id", "key").join(copies, "key", "left").withColumn(
        "node", F.coalesce("node", "row_id")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    owned = written(owned, "minhash-rows")
    classes = owned.groupBy("root").agg(first.alias("f")).select("root", F.col("f.doc_id").alias("class_id"), F.col("f.row_id").alias("head"))
    return owned.join(classes, "root").select(
        "row_id", "doc_id", "key", "class_id", (F.col("row_id") == F.col("head")).alias("kept"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class and whether it is the one that stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "class_id", "kept")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-copies, the one with the smallest id, with its columns unchanged."""
    found = written(near_duplicates(docs.select("doc_id", "text")), "minhash-found")
    # rows with one id and one text are told apart by nothing but a count
    wanted = found.groupBy("doc_id", "key").agg(
        F.max("kept").alias("kept"), F.count_if("kept").alias("stay"), F.count(F.lit(1)).alias("n")).where("kept").select(
        F.col("doc_id").alias("of"), F.col("key").alias("with"), "stay", "n")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), content_key(F.col("text")).alias("text_key"))
    match = F.col("id").eqNullSafe(F.col("of")) & F.col("text_key").eqNullSafe(F.col("with"))
    both = rows.join(wanted, match)
    once = both.where("stay < n").dropDuplicates(["of", "with"])
    return both.where("stay = n").select("row.*").unionAll(once.select("row.*"))
