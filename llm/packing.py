"""Packing documents into token sequences by length patterns.

The histogram of piece lengths is all that planning needs. Patterns of up to three bins of a few tokens that
fill a sequence are enumerated, and non-negative least squares fits how often each is used so that together
they use up the histogram. The repeats are rounded down to what is there and take the longest pieces of their
bins; the rest of the histogram, in exact lengths, is packed best-fit, longest first.
The plan has a number of rows bounded by the lengths, whatever the corpus; pieces find their places in
it by their rank among pieces of their length.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType
from tokenizers import Tokenizer

from llm.common import table
from ticketloom.session import written

CAPACITY, END = 4096, 1
#: Tokens per bin of the histogram, and pieces that a pattern has at most.
BIN, PATTERN = 16, 3
#: Pre-tokens whose ids a Python worker remembers.
REMEMBERED = 500_000
#: Rows that one rank counter handles on average.
RANK_ROWS = 50_000

# The word tokenizer's own split, for Latin letters below U+0180 whose lower case also is. A text with any
# other character, or with the opening of a special token, goes to the tokenizer as a whole.
_LETTERS, _NUMBERS = "a-zªµºß-öø-ſ", "0-9²³¹¼-¾"
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\s\x85\xa0{_LETTERS}{_NUMBERS}]+")
_OTHER = re.compile(r"[^\x00-\x1b\x20-\u012f\u0131-\u017f]|<\|")
# byte-level BPE writes a byte as a character: printable ones as themselves, the others from U+0100 on
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LEVEL = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


class TokenIds:
    """Token ids of texts as little-endian unsigned 32-bit bytes, each pre-token encoded once while it is remembered."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer, self.remembered = Tokenizer.from_file(path), remembered
        self.words: dict[str, bytes] = {}
        self.splits = path.endswith("word_bpe_49k.json")

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [_SPLIT.findall(t.lower()) if self.splits and not _OTHER.search(t) else None for t in texts]
        if len(self.words) > self.remembered:
            self.words.clear()
        known = [None if tokens is None else list(map(self.words.get, tokens)) for tokens in split]
        new = list({w for tokens, ids in zip(split, known, strict=True) if tokens and None in ids
                    for w, i in zip(tokens, ids, strict=True) if i is None})
        tokenize = self.tokenizer.model.tokenize
        for word in new:
            tokens = tokenize(word.encode().decode("latin-1").translate(_BYTE_LEVEL))
            self.words[word] = array("I", [t.id for t in tokens]).tobytes()
        whole = iter(self._whole([t for t, tokens in zip(texts, split, strict=True) if tokens is None]))
        out = []
        for tokens, ids in zip(split, known, strict=True):
            if tokens is None:
                out.append(next(whole))
            else:
                out.append(b"".join(map(self.words.__getitem__, tokens) if None in ids else ids))
        return out

    def _whole(self, texts: list[str]) -> list[bytes]:
        done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in done]  # little-endian, as all of Spark's platforms are


_ENCODERS: dict[str, TokenIds] = {}


def encoder(path: str) -> TokenIds:
    """One per Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TokenIds(path)
    return _ENCODERS[path]


def pieces_of(rows: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """``row_id, doc_id, text`` -> a row per piece: row_id, doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    A document is its ids and the end id; null text is empty. Only documents above ``capacity`` are cut.
    """
    schema = rows.select("row_id", "doc_id").schema.add("piece", "integer").add("start", "long").add(
        "length", "long").add("ids_crc32", "long")
    if keep_ids:
        schema = schema.add("ids", ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = encoder(path), np.array([END], dtype="<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = defaultdict(list)
                index = []
                texts = [t or "" for t in part.column("text").to_pylist()]
                for i, ids in enumerate(tokens.encode(texts)):
                    ids += end
                    for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                        one = ids[start:start + 4 * capacity]
                        index.append(i)
                        out["piece"].append(piece)
                        out["start"].append(start // 4)
                        out["length"].append(len(one) // 4)
                        out["ids_crc32"].append(zlib.crc32(one))
                        if keep_ids:
                            out["ids"].append(np.frombuffer(one, dtype="<u4").astype(np.int32))
                types = {"piece": pa.int32(), "ids": pa.list_(pa.int32())}
                columns = [part.column(name).take(pa.array(index)) for name in ("row_id", "doc_id")]
                yield pa.RecordBatch.from_arrays(
                    columns + [pa.array(v, types.get(k, pa.int64())) for k, v in out.items()],
                    names=["row_id", "doc_id", *out])

    return rows.select("row_id", "doc_id", "text").mapInArrow(run, schema)


def patterns(bins: int, parts: int = PATTERN) -> np.ndarray:
    """Every way to fill ``bins`` with one to ``parts`` bins, longest first; a row each, padded with zeros."""
    out = []

    def extend(taken: list[int], room: int) -> None:
        if room == 0:
            out.append(taken + [0] * (parts - len(taken)))
        elif len(taken) < parts:
            for size in range(min(room, taken[-1] if taken else room), 0, -1):
                extend([*taken, size], room - size)

    extend([], bins)
    return np.array(out)


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """Non-negative x with least |a x - b|, by active sets: columns enter by gradient, leave at zero."""
    x = np.zeros(a.shape[1])
    active = np.zeros(a.shape[1], dtype=bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(rounds):
        gradient = a.T @ (b - a @ x)
        gradient[active] = -np.inf
        best = int(np.argmax(gradient))
        if gradient[best] <= tolerance:
            break
        active[best] = True
        while True:
            chosen = np.flatnonzero(active)
            solved = np.linalg.lstsq(a[:, chosen], b, rcond=None)[0]
            if (solved > 0).all():
                x[:] = 0
                x[chosen] = solved
                break
            low = solved <= 0
            now = x[chosen]
            step = np.min(now[low] / np.maximum(now[low] - solved[low], 1e-300))
            x[chosen] = now + step * (solved - now)
            gone = chosen[(x[chosen] <= 1e-12) & low]
            gone = gone if len(gone) else chosen[low][:1]
            x[gone] = 0
            active[gone] = False
    return x


def _longest(exact: np.ndarray, pattern: list[int], repeats: int, width: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """Take the longest pieces that fit a pattern of bins out of ``exact``: the lengths taken, and how often."""
    while repeats:
        taken: dict[int, int] = defaultdict(int)
        kind = []
        for size in pattern:
            length = next(x for x in range(size * width, (size - 1) * width, -1) if exact[x] > taken.get(x, 0))
            taken[length] += 1
            kind.append(length)
        n = min(repeats, *(int(exact[x]) // c for x, c in taken.items()))
        for x, c in taken.items():
            exact[x] -= n * c
        repeats -= n
        yield tuple(kind), n


def plan_patterns(histogram: dict[int, int], capacity: int, parts: int = PATTERN, width: int = 1) -> list[tuple[tuple[int, ...], int]]:
    """``{length: pieces}`` -> ``[(lengths in a sequence, repeats)]`` that uses every piece exactly once.

    Patterns count in bins of ``width``, best fit in exact lengths.
    """
    bins = capacity // width
    exact = np.zeros(capacity + 1, dtype=np.int64)
    left = np.zeros(bins + 1, dtype=np.int64)
    for size, n in histogram.items():
        exact[size] = n
        if size <= bins * width:
            left[-(-size // width)] += n
    plan: dict[tuple[int, ...], int] = defaultdict(int)
    present = set(np.flatnonzero(left).tolist())
    options = [p for p in patterns(bins, parts).tolist() if all(s == 0 or s in present for s in p)]
    if options:
        a = np.zeros((bins + 1, len(options)))
        for j, option in enumerate(options):
            for size in option:
                if size:
                    a[size, j] += 1
        used = sorted(present)
        wanted = nnls(a[used], left[used].astype(float))
        for j in np.argsort(-wanted, kind="stable"):
            need = a[:, j].astype(np.int64)
            sizes = need > 0
            repeats = min(int(round(wanted[j])), int((left[sizes] // need[sizes]).min()))
            if repeats > 0:
                left -= repeats * need
                for kind, n in _longest(exact, [s for s in options[j] if s], repeats, width):
                    plan[kind] += n
    open_: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)  # room -> kinds of sequences with it
    for size in range(capacity, 0, -1):
        n = int(exact[size])
        while n:
            room = min((r for r in open_ if r >= size and open_[r]), default=None)
            if room is None:
                kind, have, room = (), n, capacity
            else:
                kind, have = open_[room].popitem()
            fit = room // size  # best fit fills the tightest sequence until nothing more goes in
            full = min(have, n // fit)
            takes = [(fit, full)] if full else []
            if full < have and n - full * fit:
                takes.append((n - full * fit, 1)) if n - full * fit < fit else None
            spent = sum(c for _, c in takes)
            if kind and have > spent:
                open_[room][kind] = have - spent
            for each, count in takes:
                grown, rest = kind + (size,) * each, room - size * each
                open_[rest][grown] = open_[rest].get(grown, 0) + count
                n -= each * count
    for kinds in open_.values():
        for kind, count in kinds.items():
            plan[kind] += count
    return sorted(plan.items())


def slots(plan: list[tuple[tuple[int, ...], int]]) -> pd.DataFrame:
    """The plan as rank ranges: of length ``size``, the ``n`` ranks from ``low`` on sit ``each`` to a sequence, from sequence
    ``first`` and slot ``slot`` on."""
    rows, next_rank, first = [], defaultdict(int), 0
    for kind, repeats in plan:
        slot = 0
        for size, run in groupby(kind):
            each = len(list(run))
            rows.append((size, next_rank[size], repeats * each, first, slot, each))
            next_rank[size] += repeats * each
            slot += each
        first += repeats
    return pd.DataFrame(rows, columns=["size", "low", "n", "first", "slot", "each"], dtype="int64")


def packed(pieces: DataFrame, capacity: int = CAPACITY, width: int = BIN) -> DataFrame:
    """``pieces`` (a stored table with ``row_id, piece, length``) with ``sequence_id`` and ``offset``.

    Ranks inside a length come from counters over hashed parts of it, so that a length of any size is spread.
    The plan is bounded by the lengths and the patterns kept, never more with more documents.
    """
    spark = pieces.sparkSession
    cut = pieces.withColumn("size", F.col("length").cast("long"))
    counts = cut.groupBy("size").count().collect()  # one row per length
    total = sum(r["count"] for r in counts)
    plan = slots(plan_patterns({int(r["size"]): r["count"] for r in counts}, capacity, width=width))
    parts = max(1, total // RANK_ROWS)
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("row_id", "piece"), F.lit(parts)))
    before = W.partitionBy("size").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    starts = salted.groupBy("size", "salt").agg(F.count(F.lit(1)).alias("n")).select(
        "size", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start_rank"))
    inside = W.partitionBy("size", "salt").orderBy("row_id", "piece")
    ranked = salted.withColumn("in_rank", F.row_number().over(inside) - 1).join(starts, ["size", "salt"]).withColumn(
        "rank", F.col("in_rank") + F.col("start_rank"))
    # ranks of a length -> the one range that holds them: ranges of a length are bounded by the plan
    ranges = spark.createDataFrame(plan, "size long, low long, n long, first long, slot long, each long").groupBy("size").agg(
        F.sort_array(F.collect_list(F.struct("low", "n", "first", "slot", "each"))).alias("ranges"))
    at = F.filter("ranges", lambda r: (r["low"] <= F.col("rank")) & (F.col("rank") < r["low"] + r["n"]))[0]
    placed = ranked.join(F.broadcast(ranges), "size").withColumn("at", at).withColumn(
        "in_range", F.col("rank") - F.col("at.low")).withColumn(
        "sequence_id", F.col("at.first") + F.floor(F.col("in_range") / F.col("at.each"))).withColumn(
        "slot", F.col("at.slot") + F.col("in_range") % F.col("at.each"))
    earlier = W.partitionBy("sequence_id").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0))).drop(
        "size", "salt", "in_rank", "start_rank", "rank", "ranges", "at", "in_range", "slot")


def default_tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place; repeated rows are packed as often as they stand there."""
    docs = table(spark, sf_dir, "documents").select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text")
    pieces = written(pieces_of(docs, default_tokenizer()), "pack-pieces")
    return packed(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed corpus: a row per piece with its token ids and place. Rows with null ids or texts are packed like others."""
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text")
    pieces = written(pieces_of(rows, default_tokenizer(), keep_ids=True), "pack-pieces")
    places = packed(pieces.select("row_id", "piece", "length")).select("row_id", "piece", "sequence_id", "offset")
    return pieces.join(places, ["row_id", "piece"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset")
