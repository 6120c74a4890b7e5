"""Operators 11 to 13 against brute-force versions, on small inputs with every odd case."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from check import database, rows_of_frame, rows_of_sql
from llm import conversations, kdtree, queries, spelling, substrings
from llm.fm_index import FMIndex
from llm.trellis import AFTER, NOTHING, Survivors, moves

EXTRA = ("key", "id", "part", "conv", "none", "seed", "spans", "cell", "n", "word", "form")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def odd_folder(spark, path, documents, turns):
    spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long").withColumns({n: F.lit(1) for n in EXTRA}).write.parquet(
        f"{path}/documents.parquet")
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumns({n: F.lit(1) for n in EXTRA}).write.parquet(
        f"{path}/conversations.parquet")
    return str(path)


# --- 11 ---


def cheapest(rows):
    """Every sequence of edits over rows of (initial, must be deleted, truncated)."""
    best, whole = None, re.compile(r"(s?(ua)+)?\Z")

    def go(i, cost, audit, out):
        nonlocal best
        if best and cost > best[0]:
            return
        if i == len(rows):
            for more in ("", "u", "a", "ua"):
                if whole.match(out + more):
                    offer = (cost + 2 * len(more), audit + "I" * len(more))
                    best = min(best, offer) if best else offer
            return
        initial, must, truncated = rows[i]
        for more in ("", "u", "a", "ua", "au"):
            c, a, o = cost + 2 * len(more), audit + "I" * len(more), out + more
            go(i + 1, c + 3, a + "D", o)
            if not must:
                go(i + 1, c + truncated, a + "K", o + initial)
                for role in "ua":
                    go(i + 1, c + 2 + truncated, a + "R", o + role)

    go(0, 0, "", "")
    return best


def test_survivors_find_the_cheapest_edits_and_hold_little():
    rnd, said = random.Random(3), []
    for _ in range(300):
        rows = [(rnd.choice("suaxu"), rnd.random() < .2, rnd.random() < .3) for _ in range(rnd.randint(0, 5))]
        said.clear()
        search = Survivors(NOTHING, lambda label, _: said.append(label))
        for r in rows:
            search.step(moves(*r), None)
        end = search.end_of_all()
        cost = search.finish(end) + 2 * len(AFTER[end])
        assert (cost, "".join(said) + AFTER[end]) == cheapest(rows), rows
    search, most = Survivors(NOTHING, lambda label, _: None), 0
    for _ in range(5000):
        search.step(moves(rnd.choice("sua"), rnd.random() < .1, rnd.random() < .1), None)
        most = max(most, max(len(search.unresolved(state)) for state in search.alive))
    assert most < 60


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return out


def repaired(rows):
    """The columns of the query for one conversation; plain dynamic programming over whole audits and texts."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).digest()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        found = [c for c in text if not re.match(r"[\x20\x09-\x0D]", c)]
        fault = "blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1] not in ".!?" else ""
        faults.append(fault)
        seen.add((role, text))

    def follow(state, x):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}.get((state, x))

    def insertions(paths):
        out = dict(paths)
        for _ in range(3):
            for state, (cost, audit, lines) in list(out.items()):
                for role in ("user", "assistant"):
                    end = follow(state, role[0])
                    if end is not None:
                        offer = (cost + 2, audit + "I", (*lines, f"{role}:"))
                        out[end] = min(out.get(end, offer), offer)
        return out

    paths = {"": (0, "", ())}
    for (_, _, role, text), fault in zip(rows, faults, strict=True):
        new = {}
        for state, (cost, audit, lines) in insertions(paths).items():
            offers = [(state, (cost + 3, audit + "D", lines))]
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                offers.append((follow(state, role[:1]), (cost + extra, audit + "K", (*lines, f"{role}:{text}"))))
                offers += [(follow(state, r[0]), (cost + extra + 2, audit + "R", (*lines, f"{r}:{text}"))) for r in ("user", "assistant")]
            for end, offer in offers:
                if end is not None:
                    new[end] = min(new.get(end, offer), offer)
        paths = new
    cost, audit, lines = min(p for s, p in insertions(paths).items() if s in ("", "a"))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    count = collections.Counter(faults)
    return (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def some_turns():
    rnd = random.Random(11)
    texts = ["Yes.", "no", "", " \t\n", "Why?", "Well then!", "and so on...", "x" * 40_000 + ".", None, "é — ü."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    turns = [(c, rnd.choice([*range(8), None]), rnd.choice(roles), rnd.choice(texts)) for c in [*range(60), None] for _ in range(rnd.randint(1, 7))]
    # a conversation with a third of all rows, over several ranges, with ties that last
    turns += [(1000, n, rnd.choice(roles[:4]), f"line {n % 190}{rnd.choice(['.', ''])}") for n in range(700)]
    turns += [(1001, n, "user", f"u {n}.") for n in range(150)] + [(1002, n, "tool", "") for n in range(40)] + [(1003, None, "user", "same.")] * 30
    return turns


def test_repair_equals_brute_force_and_sql(spark, tmp_path):
    turns = some_turns()
    folder = odd_folder(spark, tmp_path, [(1, "x", "en", "a", 1)], turns)
    got = {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))
           for r in conversations.op11_conversation_repair(spark, folder).collect()}
    groups = collections.defaultdict(list)
    for r in damage(turns):
        groups[r[0]].append(r)
    want = {c: repaired(groups[c]) for c in {t[0] for t in turns}}
    assert got == want
    placed = conversations.placed_turns(conversations.damaged(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")))
    assert placed.where("conv = 1000").select("part").distinct().count() > 1


def test_repaired_turns_alternate(spark):
    turns = spark.createDataFrame(some_turns(), "conv_id long, turn long, role string, text string")
    edited = conversations.edits(conversations.placed_turns(turns))
    kept = conversations.repaired_turns(turns, edited).orderBy("none", "conv", "id", "step").collect()
    for _, group in itertools.groupby(kept, key=lambda r: (r["none"], r["conv"])):
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][:1] for r in group))


# --- 12 ---


def without_repeats(docs, window):
    least = {}
    words = [(d, WORDS.findall(t or "")) for d, t in docs]
    for d, ws in words:
        for i in range(len(ws) - window + 1):
            if d is not None:
                least[tuple(ws[i:i + window])] = min(d, least.get(tuple(ws[i:i + window]), d))
    out = []
    for d, ws in words:
        stays = [True] * len(ws)
        for i in range(len(ws) - window + 1):
            if d is not None and least[tuple(ws[i:i + window])] < d:
                stays[i:i + window] = [False] * window
        kept = [w for w, s in zip(ws, stays, strict=True) if s]
        out.append((d, len(ws), len(ws) - len(kept), " ".join(kept)))
    return sorted(out, key=repr)


def test_index_names_the_smallest_document():
    rng = np.random.default_rng(1)
    for window, _ in itertools.product((1, 2, 3, 5), range(25)):
        kinds = int(rng.integers(1, 5))
        passages = [rng.integers(0, kinds, int(rng.integers(1, 14))) for _ in range(int(rng.integers(1, 12)))]
        documents = rng.integers(0, 9, len(passages))
        least = {}
        for p, d in zip(passages, documents, strict=True):
            for i in range(len(p) - window + 1):
                least[tuple(p[i:i + window])] = min(d, least.get(tuple(p[i:i + window]), d))
        for p, found in zip(passages, FMIndex(passages, documents, kinds, window).smallest_documents(passages), strict=True):
            assert list(found) == [least[tuple(p[i:i + window])] for i in range(len(p) - window + 1)]


def some_documents():
    rnd = random.Random(12)
    shared = [" ".join(f"s{k}w{i}" for i in range(70)) for k in range(4)]
    docs = [(n, " ".join(rnd.choice([f"u{n}x{i}", "the", rnd.choice(shared), "a b"]) for i in range(rnd.randint(0, 9)))) for n in range(120)]
    docs += [(n, f"left{n} {shared[0]}\tright{n}\n") for n in range(200, 260)]  # one passage in ever new surroundings
    docs += [(7, docs[30][1]), (7, docs[30][1]), (None, shared[1]), (None, shared[1]), (300, None), (301, ""), (302, " \n\t ")]
    docs += [(303, "same " * 20_000), (304, "same " * 5_000), (1, shared[2]), (305, "é漢字 " * 60), (306, "é漢字 " * 60)]
    return docs


@pytest.mark.parametrize("window, hot", [(50, 1024), (50, 8), (6, 4), (1, 2)])
def test_repeats_equal_brute_force(spark, window, hot):
    docs = some_documents()
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({n: F.lit(1) for n in ("passage", "seed")}).repartition(5)
    got = substrings.remove_repeats(frame, window, hot=hot)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == without_repeats(docs, window)


# --- 13 ---


def spellings(docs):
    n = collections.Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1:] for i in range(len(b)))

    forms, counts = {}, {}
    for w in n:
        others = [o for o in n if o != w and near(w, o)]
        best = min(others, key=lambda o: (-n[o], o), default=None)
        counts[w], forms[w] = len(others), best if best and n[best] >= 10 * n[w] else None

    def root(w):
        return root(forms[w]) if forms[w] else w

    return sorted(((w, forms[w], root(w), n[w], counts[w], n[forms[w]] if forms[w] else None) for w in n), key=repr)


def spelled_documents():
    rnd = random.Random(13)
    base = ["".join(rnd.choice("abcdeéÿ") for _ in range(rnd.randint(7, 11))) for _ in range(25)] + ["aaaaaaa", "abababab", "babababa"]

    def typo(w):
        i = rnd.randrange(len(w) + 1)
        return rnd.choice([w[:i] + rnd.choice("abxé") + w[i:], w[:i] + w[i + 1:], w[:i] + "q" + w[i + 1:]])

    docs = []
    for d in range(60):
        words = [w if rnd.random() < .8 else typo(w) if rnd.random() < .8 else typo(typo(w)) for w in rnd.choices(base, range(len(base), 0, -1), k=80)]
        docs.append((d, " ".join(w.upper() if rnd.random() < .1 and w.isascii() else w for w in words) + " 12 ok, Ωmega_x"))
    return docs + [(None, docs[0][1]), (3, docs[3][1]), (61, None), (62, ""), (63, "x" * 100_000 + " " + "x" * 100_000)]


@pytest.mark.parametrize("cell, sample", [(16_384, 200_000), (20, 400), (5, 60)])
def test_variants_equal_brute_force(spark, cell, sample):
    docs = spelled_documents()
    words = spelling.word_counts(spark.createDataFrame(docs, "doc_id long, text string").withColumn("word", F.lit(1)).repartition(4))
    got = spelling.variants(words, cell, sample).select("word", "form", "root", "n", "n_near", "form_n")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == spellings(docs)


def test_roots_follow_long_chains(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(18)], "word string, form string")
    assert {r["root"] for r in spelling.roots(forms).collect()} == {"w18"}


def test_trees_reach_every_word_one_edit_away():
    rnd = random.Random(5)
    words = sorted({"".join(rnd.choice("abcé") for _ in range(8)) for _ in range(900)})
    longer = sorted({w[:i] + "b" + w[i:] for w in words[:100] for i in (0, 4, 8)})
    cell = kdtree.Cell(words)
    for asked in (words, longer, [w[1:] for w in words[:200]]):
        found, first = cell.search(asked)
        for w, n, f in zip(asked, found, first, strict=True):
            near = [i for i, o in enumerate(words) if o != w and (
                sum(a != b for a, b in zip(w, o, strict=True)) == 1 if len(o) == len(w)
                else any((o[:k] + o[k + 1:] if len(o) > len(w) else w[:k] + w[k + 1:]) == (w if len(o) > len(w) else o) for k in range(9)))]
            assert (n, f) == (len(near), near[0] if near else -1)


# --- all three ---


@pytest.mark.parametrize("name", ["op11_conversation_repair", "op12_substring_dedup", "op13_spelling_variants"])
def test_odd_tables_agree_with_sql(spark, tmp_path, name):
    folder = odd_folder(spark, tmp_path, [(d, t, "en", "a", 1) for d, t in some_documents()[::3] + spelled_documents()[:6]], some_turns()[:250])
    con = database("/root/testdata/sf0.001")
    for table in ("documents", "conversations"):
        con.execute(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    assert rows_of_frame(queries.QUERIES[name](spark, folder)) == rows_of_sql(con, queries.ORACLES[name])


@pytest.mark.parametrize("name", ["op11_conversation_repair", "op12_substring_dedup", "op13_spelling_variants"])
def test_empty_tables_give_no_rows(spark, tmp_path, name):
    folder = odd_folder(spark, tmp_path, [], [])
    assert queries.QUERIES[name](spark, folder).count() == 0
