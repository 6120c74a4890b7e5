"""Conversation structure repair: the cheapest edits after which roles alternate and no turn is blank or repeated.

Turns come by number (missing numbers first), then role, then MD5 of the text; a conversation may be of any size. Only
small rows are sorted: places, roles, hashes and what the text ends with.

1. Rows are sorted over ranges, so that a large conversation lies in several. Repeats are found by a count per
   conversation, role and text.
2. A conversation inside one range is one run of the Viterbi search (``trellis``). Of one that spans ranges, each part
   gives the cheapest way between any two states; a part has one row of 16 costs, and the parts of a conversation are
   joined by the same search. Then every part is searched again between the states it was given.
3. Edits meet the texts by hash; only texts that stay are moved.

Nulls in role and text count as one space. Rows of a null conversation id are one conversation. Rows that agree in
all columns are repeats of each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import table
from llm.trellis import AFTER, INSERT, NOTHING, Survivors, USER, moves, next_state
from ticketloom.session import written

SPACES = " \t\n\x0b\x0c\r"
KEY = ["none", "conv"]
#: Bits of a row number that count inside a range.
RANGE = 33


def _keyed(turns: DataFrame) -> DataFrame:
    return turns.select(
        F.col("conv_id").isNull().alias("none"), F.coalesce("conv_id", F.lit(0)).cast("long").alias("conv"), "turn",
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))


def placed_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` -> a written table of rows with their place and their faults, without texts."""
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    narrow = _keyed(turns).select(
        *KEY, "turn", "role", F.unhex(F.md5("text")).alias("digest"), (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("truncated"))
    # equal rows may be cut apart anywhere, so that even they need not share a range
    order = [*KEY, "turn", "role", "digest", "any"]
    ranges = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = written(narrow.withColumn("any", F.monotonically_increasing_id()).repartitionByRange(ranges, *order).sortWithinPartitions(
        *order).drop("any").withColumn("id", F.monotonically_increasing_id()), "turns")
    same = [*KEY, "role", "digest"]
    first = placed.where("not blank").groupBy(*same).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    fault = F.when(F.col("blank"), "blank").when(F.col("id") > F.col("first"), "duplicate").when(F.col("truncated"), "truncated")
    return written(placed.join(first, same, "left").select(
        *KEY, "id", F.shiftright("id", RANGE).alias("part"), "turn", "role", "digest", F.left("role", F.lit(1)).alias("initial"), fault.alias("fault")),
        "turn-faults")


def _ways(initial: str, fault: str | None) -> dict:
    return moves(initial if initial in ("s", "u", "a") else "", fault in ("blank", "duplicate"), fault == "truncated")


def _in_order(rows: DataFrame) -> DataFrame:
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(ranges, "part").sortWithinPartitions("id")


_PART = "none boolean, conv long, part long, costs array<long>, ranks array<int>, last string"


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order -> per conversation and range the cost from each state to each (-1: never best), and the order of the labels."""
    def done() -> pa.RecordBatch:
        costs, labels = [], []
        for survivors, said in searches:
            ends = dict(survivors.alive)
            for end in range(4):
                costs.append(ends[end][0] if end in ends else -1)
                labels.append("".join(said) + survivors.unresolved(end) if end in ends else "")
        order = {label: rank for rank, label in enumerate(sorted(set(labels)))}
        return pa.RecordBatch.from_arrays([pa.array([k], t) for k, t in zip(
            (*key, costs, [order[x] for x in labels], last), (pa.bool_(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.string()),
            strict=True)], ["none", "conv", "part", "costs", "ranks", "last"])

    key, searches, last = None, [], None
    for batch in batches:
        for *mine, initial, fault in zip(*(batch.column(n).to_pylist() for n in (*KEY, "part", "initial", "fault")), strict=True):
            if mine != key:
                if key:
                    yield done()
                key, searches = mine, []
                for state in range(4):
                    said: list[str] = []
                    searches.append((Survivors(state, lambda label, _, said=said: said.append(label)), said))
            for survivors, _ in searches:
                survivors.step(_ways(initial, fault), None)
            last = initial
    if key:
        yield done()


@dataclass(frozen=True, order=True)
class _Way:
    """The cheapest way through a part; ways with the same labels are equal whatever states they join."""

    rank: int
    start: int = field(compare=False)
    end: int = field(compare=False)


def _linked(parts: pd.DataFrame) -> pd.DataFrame:
    """The parts of one conversation, one row per range -> the states between which each is searched."""
    parts = parts.sort_values("part").reset_index(drop=True)
    steps: list[_Way] = []
    search = Survivors(NOTHING, lambda way, _: steps.append(way))
    for costs, ranks in zip(parts["costs"], parts["ranks"], strict=True):
        search.step({j: [(i, int(costs[4 * i + j]), _Way(int(ranks[4 * i + j]), i, j)) for i in range(4) if costs[4 * i + j] >= 0]
                     for j in range(4)}, None, give_up=False)
    search.finish(search.end_of_all())
    return pd.DataFrame({
        "none": parts["none"], "conv": parts["conv"], "part": parts["part"], "start": [s.start for s in steps], "end": [s.end for s in steps],
        "previous": parts["last"].shift(1), "closes": parts.index == len(parts) - 1})


_LINK = "none boolean, conv long, part long, start int, end int, previous string, closes boolean"
_EDIT = pa.schema([
    ("none", pa.bool_()), ("conv", pa.int64()), ("part", pa.int64()), ("id", pa.int64()), ("step", pa.int32()), ("edit", pa.string()), ("role", pa.string()),
    ("given", pa.string()), ("digest", pa.binary()), ("cost", pa.int64()), ("fault", pa.string()), ("illegal", pa.bool_())])


class _Part:
    """The search through one conversation, or a part of it; turns labels into rows of edits."""

    def __init__(self, key: list, start: int | None, end: int | None, previous: str | None, closes: bool | None, out: list):
        self.key, self.end, self.closes, self.out = key, end, end is None or closes, out
        self.state, self.previous = start or NOTHING, previous
        self.search = Survivors(self.state, self.write)
        self.last = None

    def turn(self, id_: int, initial: str, role: str, digest: bytes, fault: str | None) -> None:
        illegal = self.previous is not None and self.previous + initial not in ("su", "ua", "au")
        self.previous, self.last = initial, id_
        self.search.step(_ways(initial, fault), (id_, initial, role, digest, fault, illegal))

    def insert(self, id_: int, step: int) -> None:
        role = "assistant" if self.state == USER else "user"
        self.state = next_state(self.state, role[0])
        self.out.append((*self.key, id_, step, "I", role, None, None, INSERT, None, False))

    def write(self, label: str, row: tuple) -> None:
        id_, initial, given, digest, fault, illegal = row
        for step in range(len(label) - 1):
            self.insert(id_, step)
        edit, role, cost = label[-1], None, 3
        if edit != "D":
            cost = (2 if edit == "R" else 0) + (fault == "truncated")
            if edit == "R":
                role = "assistant" if self.state == USER else "user"
            self.state = next_state(self.state, role[0] if role else initial)
        self.out.append((*self.key, id_, 2, edit, role or given, given, digest, cost, fault, illegal))

    def close(self) -> None:
        end = self.search.end_of_all() if self.end is None else self.end
        self.search.finish(end)
        if self.closes:
            for step in range(len(AFTER[end])):
                self.insert(self.last, 3 + step)


def _editing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [[]] * len(_EDIT)
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _EDIT.types, strict=True)], schema=_EDIT)
        out.clear()
        return batch

    out: list[tuple] = []
    part = None
    for batch in batches:
        names = (*KEY, "part", "start", "end", "previous", "closes", "id", "initial", "role", "digest", "fault")
        for none, conv, number, start, end, previous, closes, *turn in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            key = [none, conv, number]
            if part is None or part.key != key:
                if part:
                    part.close()
                part = _Part(key, start, end, previous, closes, out)
            part.turn(*turn)
        yield flush()
    if part:
        part.close()
    yield flush()


def edits(placed: DataFrame) -> DataFrame:
    """``placed_turns`` -> a written table of the edits in order of ``id, step``: K, R, D per row, I before or after one.

    ``role`` is the new role, ``given`` and ``digest`` say which text an edit keeps, ``cost`` its cost.
    """
    wide = placed.groupBy(*KEY).agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a < b").select(*KEY)
    parts = _in_order(placed.join(wide, KEY, "left_semi")).mapInArrow(_summaries, _PART)
    links = written(parts.groupBy(*KEY).applyInPandas(_linked, _LINK), "turn-links")  # a conversation has one row per range
    return written(_in_order(placed.join(links, [*KEY, "part"], "left")).mapInArrow(_editing, (
        "none boolean, conv long, part long, id long, step int, edit string, role string, given string, digest binary, "
        "cost long, fault string, illegal boolean")), "turn-edits")


def repaired_turns(turns: DataFrame, edited: DataFrame) -> DataFrame:
    """The turns after repair: ``none, conv, id, step, edit, role, text``, in order of ``id, step``."""
    texts = _keyed(turns).withColumn("digest", F.unhex(F.md5("text"))).groupBy(*KEY, F.col("role").alias("given"), "digest").agg(
        F.any_value("text").alias("text"))
    columns = [*KEY, "id", "step", "edit", "role", "text"]
    kept = edited.where("edit in ('K', 'R')").join(texts, [*KEY, "given", "digest"]).select(*columns)
    return kept.unionAll(edited.where("edit = 'I'").withColumn("text", F.lit("")).select(*columns))


def audits(edited: DataFrame) -> DataFrame:
    """Per conversation the letters of its edits, their cost and its faults. A range's letters are joined first."""
    def faults(name: str):
        return F.count_if(F.col("fault") == name).alias(name)

    letters = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("id", "step", "edit"))), lambda e: e["edit"]), "")
    per_part = edited.groupBy(*KEY, "part").agg(
        letters.alias("audit"), F.sum("cost").alias("cost"), F.count_if("illegal").alias("illegal"), *[faults(n) for n in ("blank", "duplicate", "truncated")])
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "audit"))), lambda e: e["audit"]), "")
    return per_part.groupBy(*KEY).agg(whole.alias("audit"), *[F.sum(n).alias(n) for n in ("cost", "illegal", "blank", "duplicate", "truncated")])


def _hashing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, state = None, None
    done: list[tuple] = []
    for batch in batches:
        for none, conv, role, text in zip(*(batch.column(n).to_pylist() for n in (*KEY, "role", "text")), strict=True):
            if (none, conv) != key:
                if key:
                    done.append((*key, state.hexdigest()))
                key, state = (none, conv), hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
        yield _hashes(done)
        done = []
    yield _hashes([*done, (*key, state.hexdigest())] if key else [])


def _hashes(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.bool_(), pa.int64(), pa.string()), strict=True)], [*KEY, "sha"])


def text_hashes(repaired: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines. The hash goes from line to line, so a conversation is read by
    one task, row by row; nothing of it is held."""
    ranges = int(repaired.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return repaired.repartition(ranges, *KEY).sortWithinPartitions(*KEY, "id", "step").select(*KEY, "role", "text").mapInArrow(
        _hashing, "none boolean, conv long, sha string")


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with the damage that a checksum of conversation and turn asks for; a null counts as one space."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    check = F.crc32(F.concat_ws(":", *named).cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), check.alias("check")).where("check <> 0").select(
        "conv_id", "turn", F.when(F.col("check") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("check") == 1, "").when(F.col("check") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("check") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = damaged(given)
    placed = placed_turns(turns)
    edited = edits(placed)
    numbers = placed.groupBy(*KEY, "turn").agg(F.count(F.lit(1)).alias("n")).groupBy(*KEY).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    hashes = text_hashes(repaired_turns(turns, edited))
    every = given.select(F.col("conv_id").isNull().alias("none"), F.coalesce("conv_id", F.lit(0)).cast("long").alias("conv")).distinct()
    joined = every.join(numbers, KEY, "left").join(audits(edited), KEY, "left").join(hashes, KEY, "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        F.when(~F.col("none"), F.col("conv")).alias("conv_id"), *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def _sql_moves() -> str:
    """Every edit from every state, as rows: state, state after, kind, initial it needs, label, inserted lines, new role, cost."""
    rows = []
    names = {NOTHING: {2: "u", 3: "ua"}, 1: {2: "u", 3: "ua"}, USER: {3: "a"}, 3: {2: "u"}}
    lines = {"u": "user:", "a": "assistant:"}
    for start in range(4):
        for middle, inserted in {start: "", **names[start]}.items():
            added = "".join(f"|{lines[x]}" for x in inserted)
            n = len(inserted)
            rows.append((start, middle, "D", "", "I" * n + "D", added, "", 2 * n + 3))
            for initial in "sua":
                end = next_state(middle, initial)
                if end is not None:
                    rows.append((start, end, "K", initial, "I" * n + "K", added, "", 2 * n))
                    if initial != "s":
                        rows.append((start, end, "R", "", "I" * n + "R", added, lines[initial][:-1], 2 * n + 2))
    return ", ".join(str(r) for r in rows)


ORACLE = f"""
WITH RECURSIVE bits(i, c, k) AS (
  SELECT i, CAST(i AS BIGINT), 0 FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
given AS (
  SELECT conv_id IS NULL AS none, coalesce(conv_id, 0) AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
      lambda x: CAST(ord(x) AS BIGINT)), lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)]), 4294967295), 4294967295) % 20 AS h
  FROM conversations, crc),
damaged AS (
  SELECT none, conv, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS copy FROM given WHERE h <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY none, conv ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
    right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last, left(role, 1) AS initial FROM damaged),
turns AS (
  SELECT *, CASE WHEN last = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY none, conv, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY none, conv ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS illegal FROM placed),
moves(s, e, kind, needs, label, added, name, cost) AS (VALUES {_sql_moves()}),
paths AS (
  SELECT DISTINCT none, conv, CAST(0 AS BIGINT) AS i, 0 AS s, {{'c': CAST(0 AS BIGINT), 'a': '', 'o': ''}} AS v FROM turns
  UNION ALL
  SELECT p.none, p.conv, t.i, m.e, min({{'c': p.v.c + m.cost + CASE WHEN m.kind <> 'D' AND t.fault = 'truncated' THEN 1 ELSE 0 END, 'a': p.v.a || m.label,
    'o': p.v.o || replace(m.added, '|', chr(10)) || CASE m.kind WHEN 'K' THEN chr(10) || t.role || ':' || t.text
      WHEN 'R' THEN chr(10) || m.name || ':' || t.text ELSE '' END}})
  FROM paths p JOIN turns t ON t.none = p.none AND t.conv = p.conv AND t.i = p.i + 1
  JOIN moves m ON m.s = p.s AND (m.kind = 'D' OR t.fault NOT IN ('blank', 'duplicate')) AND (m.kind <> 'K' OR m.needs = t.initial)
  GROUP BY p.none, p.conv, t.i, m.e),
sums AS (
  SELECT none, conv, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal
  FROM turns GROUP BY 1, 2),
best AS (
  SELECT none, conv, min({{'c': v.c + [0, 4, 2, 0][s + 1], 'a': v.a || ['', 'II', 'I', ''][s + 1], 'o': v.o || replace(['', '|user:|assistant:', '|assistant:', ''][s + 1], '|', chr(10))}}) AS v
  FROM paths JOIN sums USING (none, conv) WHERE i = n GROUP BY 1, 2)
SELECT CASE WHEN NOT none THEN conv END AS conv_id, {', '.join(f'CAST(coalesce({n}, 0) AS BIGINT) AS {n}' for n in ('gaps', 'blank', 'duplicate', 'truncated', 'illegal'))},
  CAST(coalesce(v.c, 0) AS BIGINT) AS cost, coalesce(v.a, '') AS audit, sha256(coalesce(substr(v.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT none, conv FROM given) LEFT JOIN sums USING (none, conv) LEFT JOIN best USING (none, conv)
"""
