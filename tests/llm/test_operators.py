"""Each operator against a brute-force version or an exact round trip, on small inputs with every odd case."""

import collections
import itertools
import json
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm import extract, lines, minhash, mixing, packing, preferences, quality, toxicity, vectors, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(9000))
BASE = " ".join(f"t{i}" for i in range(60))
LINES = "alpha one two\nbeta three four\ngamma five six\ndelta seven"


def rows_of(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def odd_documents(spark):
    """Nulls in every column, empty and very long texts, exact and near copies, repeated rows and lines."""
    near = BASE.replace("t30", "other")
    data = [
        (1, BASE, "en", "a"), (2, BASE, "en", "a"), (3, near, "en", "b"), (4, None, None, None), (5, "", "de", "b"),
        (6, LONG, "en", "c"), (7, LINES, "fr", "a"), (8, "zz top\n" + LINES, "fr", None), (7, LINES, "fr", "a"),
        (None, "a null id here", "en", "a"), (10, "one two", "en", "c"), (11, "   \n\t ", "es", "c"),
        (12, "stupid idiot\n" * 8, "en", "a"), (13, "Σ İ 漢字 <|endoftext|> é", "en", "b")]
    return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in data], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return odd_documents(spark).cache()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables of odd rows, with columns whose names operators use themselves."""
    path = str(tmp_path_factory.mktemp("odd"))
    odd_documents(spark).withColumns({n: F.lit(1) for n in ("key", "size", "row", "kept", "score", "node", "stats", "piece")}).write.parquet(
        f"{path}/documents.parquet")
    labels = [(1, 1, 0), (1, 0, 0), (3, 1, None), (None, 1, 1), (12, None, 1), (6, 1, 0), (99, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    v = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [0.9, 0.1], 2), (4, None, 1), (5, [0.0, 0.0], 1), (6, [1.0, None], 1),
         (7, [1.0, float("nan")], 1), (8, [1.0, 0.0, 0.0], 1), (None, [-1.0, 0.0], None), (9, [], 1), (1, [0.0, 1.0], 3)]
    spark.createDataFrame(v, "vec_id long, embedding array<float>, label int").write.parquet(f"{path}/embeddings.parquet")
    turns = [(0, 0, "user", "hi"), (0, 1, "assistant", "yes"), (1, 0, "user", "hi"), (1, 1, "assistant", "no"), (1, 2, "user", None),
             (2, 0, "user", "alone"), (3, 0, None, "x"), (3, 5, "assistant", None), (None, 0, "user", "q"), (4, 0, "system", "s"), (4, 0, "system", "s")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{path}/conversations.parquet")
    pages = [(1, "http://a", "<p>One &amp; two<p>three"), (2, None, None), (None, "u", ""), (3, "u", "no markup"), (3, "u", "no markup")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
    return path


@pytest.fixture(scope="module")
def empty(spark, folder, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "labels", "embeddings", "conversations", "pages"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{path}/{name}.parquet")
    return path


QUERIES = {
    "op1": preferences.op1_preference_format, "op2": warc.op2_warc_derivatives, "op3": quality.op3_quality_rules,
    "op4": packing.op4_packing, "op5": lines.op5_line_dedup, "op6": vectors.op6_embedding_links, "op7": mixing.op7_mixing,
    "op8": toxicity.op8_toxicity, "op9": extract.op9_main_text, "op10": minhash.op10_near_duplicates}


@pytest.mark.parametrize("name", QUERIES)
def test_odd_rows_give_whole_results(spark, folder, name):
    table = {"op1": None, "op2": None, "op6": "embeddings", "op9": "pages", "op4": None}.get(name, "documents")
    n = QUERIES[name](spark, folder).count()
    if table:
        assert n == spark.read.parquet(f"{folder}/{table}.parquet").count()
    assert n > 0


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables_give_no_rows(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == 0


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES[:-1]])
def test_stages_return_the_columns_of_documents(spark, folder, empty, stage):
    for path in (folder, empty):
        docs = spark.read.parquet(f"{path}/documents.parquet")
        out = stage(spark, docs, path)
        assert out.columns == docs.columns
        assert (out.count() == 0) == (path == empty)


def test_pipeline_runs_over_odd_rows(spark, folder):
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert pieces and all(len(p["ids"]) == p["length"] for p in pieces)
    assert 5 not in {p["doc_id"] for p in pieces} and 1 in {p["doc_id"] for p in pieces}


# --- op1 ---


def test_prefix_is_rendered_once_and_completions_are_masked(spark):
    sides = [[(1, 0, "user", "q"), (1, 1, "assistant", "good"), (1, 2, "user", "more")], [(1, 0, "user", "q"), (1, 1, "assistant", "bad")]]
    made = [spark.createDataFrame(s, "pair_id long, position long, role string, text string") for s in sides]
    got = preferences.format_preferences(*made).orderBy("part", "position").collect()
    assert [(r["part"], r["segment"]) for r in got] == [
        ("chosen", "<|assistant|>\ngood<|end|>\n"), ("chosen", "<|user|>\nmore<|end|>\n"),
        ("prompt", "<|user|>\nq<|end|>\n"), ("rejected", "<|assistant|>\nbad<|end|>\n")]
    assert [r["segment"][r["loss_start"]:r["loss_end"]] for r in got] == ["good<|end|>", "", "", "bad<|end|>"]
    assert got[1]["start"] == len(got[0]["segment"])


def test_long_conversations_are_placed_in_ranges(spark):
    turns = spark.range(1500).select(F.lit(1).alias("pair_id"), F.col("id").alias("position"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    got = preferences.format_preferences(turns, turns).orderBy("position").collect()
    at = 0
    for r in got:
        assert (r["part"], r["start"]) == ("prompt", at)
        at += len(r["segment"])


def test_every_row_of_a_turn_is_kept_as_in_the_sql(spark, tmp_path):
    import duckdb

    turns = [(0, 0, "user", "hi"), (0, 1, "assistant", "same"), (0, 1, "assistant", "same"), (0, None, "user", "no turn"),
             (1, 0, "user", "hi"), (1, 3, "assistant", "b"), (None, 0, "user", "q")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    got = preferences.op1_preference_format(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", turns)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({preferences.ORACLE})").fetchall()
    assert rows_of(got, *got.columns) == sorted(want, key=repr)
    retried = spark.createDataFrame([(0, 1, "assistant", t) for t in ("a", "b")] + [(0, None, "user", str(i)) for i in range(700)], "conv_id long, turn long, role string, text string")
    chosen, _ = preferences.preference_pairs(retried)
    rows = chosen.orderBy("position").collect()
    assert [r["position"] for r in rows] == list(range(702)) and [r["text"] for r in rows[:2]] == ["a", "b"]
    assert {r["text"] for r in rows[2:]} == {str(i) for i in range(700)}


# --- op2 ---


def test_warc_files_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/1", "<title>T &amp; t</title><body><a href='/x'>go</a> é\r\n\r\nend"), (2, "http://a/2", "")], "page_id long, url string, html string")
    records = warc.derivatives(warc.page_responses(pages))
    warc.write_warc(records, f"{tmp_path}/out", "gzip")
    back = warc.read_warc(spark, f"{tmp_path}/out")
    names = ["record_type", "record_id", "refers_to", "target_uri", "date", "content_type", "content_length", "block"]
    assert rows_of(back, *names) == rows_of(records, *names)
    assert back.where("not whole").count() == 0
    for r in records.collect():
        assert r["block_digest"] == warc.digest(r["block"].encode()) and r["content_length"] == len(r["block"].encode())
        if r["record_type"] == "metadata" and r["target_uri"].endswith("1"):
            assert json.loads(r["block"])["html"] == {"title": "T & t", "links": ["/x"]}


# --- op3 ---


def test_binomial_bound_is_exact():
    for k, n, p in ((0, 20, 0.1), (3, 50, 0.02), (10, 30, 0.5), (49, 50, 0.9)):
        exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert quality.binomial_tail(k, n, p) == pytest.approx(exact, rel=1e-9)
    assert quality.binomial_tail(2, 300, quality.upper_bound(2, 300, 0.05)) == pytest.approx(0.05, rel=1e-6)


def test_statistics_by_brute_force():
    for text in ("a b c d e f a b c d e", "x # y\nx # y\n\n  \nx # y", "one", "", None, "a " * 40, "p q r s t\x85u v|"):
        words = [w for w in "".join(c if c not in " \t\n\v\f\r" else " " for c in text or "").split(" ") if w]
        windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        hit = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 5)}
        kept = [x for x in (text or "").split("\n") if x.strip(" \t\n\v\f\r")]
        assert quality.text_stats(text) == (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(kept), len(kept) - len(set(kept)), len(hit))


def test_cutoffs_are_certified_lenient_and_limited(spark):
    good = [(i, "plain words of a good text number " + " ".join(f"w{i}x{k}" for k in range(20)), "en", 1) for i in range(900)]
    bad = [(1000 + i, " ".join(f"w{i}x{k} ###" for k in range(12)), "en", 0) for i in range(60)]
    few = [(2000 + i, " ".join(f"v{i}x{k}" for k in range(12)), "de", 1) for i in range(20)]
    data = spark.createDataFrame(good + bad + few, "doc_id long, text string, lang string, quality int")
    cuts = quality.fit_cutoffs(data, data.select("doc_id", "quality"), risk=0.05).collect()
    assert {c["stratum"] for c in cuts} == {"en"}  # twenty holdouts certify nothing
    by = {c["rule"]: c for c in cuts}
    assert by["symbols_per_word"]["bad_rejected"] == 60 and by["symbols_per_word"]["good_rejected"] == 0
    assert all(c["bound"] <= 0.05 / len(quality.RULES) for c in cuts)


def test_texts_without_words_are_judged(spark, tmp_path):
    good = [(i, "plain words of a good text number " + " ".join(f"w{i}x{k}" for k in range(20)), "en") for i in range(1600)]
    bad = [(2000 + i, " ".join(f"w{i}x{k} ###" for k in range(12)), "en") for i in range(60)]
    none = [(3000, None, "en"), (3001, "", "en"), (3002, " \n\t ", "en"), (3003, None, None), (None, "", None)]
    data = spark.createDataFrame(good + bad + none, "doc_id long, text string, lang string").cache()
    data.write.parquet(f"{tmp_path}/documents.parquet")
    data.select("doc_id", (F.col("doc_id") < 2000).cast("int").alias("quality")).write.parquet(f"{tmp_path}/labels.parquet")
    got = collections.Counter(tuple(r) for r in quality.op3_quality_rules(spark, str(tmp_path)).collect())
    assert got == collections.Counter(
        (i, s[0], s[1], s[2], s[4], s[5], s[0] < 10, s[0] >= 10 and i < 2000)
        for i, s in ((i, quality.text_stats(text)) for i, text, _ in good + bad + none))
    stage = quality.quality_stage(spark, data, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in stage) == list(range(1600))


# --- op4 ---


def test_plans_use_every_piece_once_and_few_sequences():
    rng = np.random.default_rng(4)
    for sizes in (rng.integers(1, 257, 3000), np.full(500, 129), np.ones(1000, int), rng.geometric(0.03, 4000).clip(1, 256)):
        histogram = collections.Counter(sizes.tolist())
        plan = packing.plan_patterns(histogram, 256)
        used = collections.Counter()
        for kind, n in plan:
            assert sum(kind) <= 256
            for size in kind:
                used[size] += n
        assert used == histogram
        least = max(-(-int(sizes.sum()) // 256), int((sizes > 128).sum()))
        assert sum(n for _, n in plan) <= 1.06 * least + 1


def test_short_pieces_fill_sequences(spark):
    lengths = [1] * 5000 + [2] * 9000 + [17, 33] * 600 + [3000] * 7
    pieces = spark.createDataFrame([(i, 0, n) for i, n in enumerate(lengths)], "row_id long, piece int, length int")
    got = packing.packed(packing.written(pieces, "short")).groupBy("sequence_id").agg(
        F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"), F.count("*").alias("pieces")).collect()
    assert all(r["n"] == r["end"] <= 4096 for r in got) and sum(r["pieces"] for r in got) == len(lengths)
    assert len(got) <= -(-sum(lengths) // 4096) + 1


def test_nnls_meets_its_conditions():
    rng = np.random.default_rng(5)
    a, b = rng.random((20, 40)), rng.random(20) * 5
    x = packing.nnls(a, b)
    gradient = a.T @ (b - a @ x)
    assert (x >= 0).all() and gradient.max() < 1e-6 and np.abs(gradient[x > 0]).max() < 1e-6


def test_pieces_are_the_tokenizers_ids_placed_gapless(spark, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_tokenizer())
    ids = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text")
    table = packing.written(packing.pieces_of(ids, packing.default_tokenizer(), keep_ids=True), "t")
    got = packing.packed(table).collect()
    want = collections.Counter()
    for r in docs.collect():
        tokens = t.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        for k, s in enumerate(range(0, len(tokens), 4096)):
            one = tokens[s:s + 4096]
            want[(r["doc_id"], k, s, len(one), zlib.crc32(np.array(one, "<u4").tobytes()), tuple(one))] += 1
    assert want == collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], tuple(r["ids"])) for r in got)
    for _, group in itertools.groupby(sorted(got, key=lambda r: (r["sequence_id"], r["offset"])), key=lambda r: r["sequence_id"]):
        at = 0
        for r in group:
            assert r["offset"] == at
            at += r["length"]
        assert at <= 4096


# --- op5 ---


def test_later_windows_go_and_first_stay(spark, docs):
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in docs.select("doc_id", "text").transform(
        lambda d: lines.dedup_lines(d).select("doc_id", F.col("clean").alias("text"), "n_removed")).collect()}
    assert got[7] == (LINES, 0) and got[8] == ("zz top", 4) and got[4] == (None, 0) and got[5] == ("", 0)
    # eight equal lines: later windows cover all but the first of them, as the SQL has it; the final empty line stays
    assert got[12] == ("stupid idiot\n", 7)


def test_one_of_repeated_and_null_id_rows_keeps_its_lines(spark, tmp_path):
    data = [(7, LINES)] * 3 + [(None, "n " + LINES)] * 40 + [(8, LINES), (9, "own one\nown two\nown three")]
    spark.createDataFrame(data, "doc_id long, text string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = collections.Counter(tuple(r) for r in lines.op5_line_dedup(spark, str(tmp_path)).select("doc_id", "text", "n_removed").collect())
    # the null-id texts share the window of lines two to four with document 7
    assert got == {(7, LINES, 0): 1, (7, "", 4): 2, (8, "", 4): 1, (9, "own one\nown two\nown three", 0): 1,
                   (None, "n alpha one two", 3): 1, (None, "", 4): 39}


@pytest.mark.parametrize("again", [2, 1000])
def test_lines_come_off_the_right_rows_whatever_order_they_come_in(spark, monkeypatch, again):
    monkeypatch.setattr(lines, "AGAIN", again)
    data = [(7, LINES, None, "x")] * 7 + [(7, LINES, "x", None)] * 2 + [(None, LINES, None, None)] * 5 + [
        (i, f"own {i}\nown two {i}\n{LINES}", "x", "y") for i in range(20, 60)]
    rows = spark.createDataFrame(data, "doc_id long, text string, row_id string, covered string")
    # rows after such a shuffle come in another order and other partitions each time they are read
    shuffled = rows.repartition(7, F.rand()).withColumn("k1", F.lit(1)).withColumn("lines", F.lit("z"))
    got = collections.Counter(tuple(r) for r in lines.dedup_lines(shuffled).select(
        "doc_id", "row_id", "covered", "k1", "lines", "clean", "n_lines", "n_removed").collect())
    whole = [k for k, n in got.items() if k[7] == 0 for _ in range(n)]
    assert len(whole) == 1 and whole[0][0] == 7 and whole[0][5] == LINES and sum(got.values()) == len(data)
    assert collections.Counter(k[:3] for k in got.elements()) == collections.Counter((r[0], r[2], r[3]) for r in data)
    assert all(k[5:] == ("", 4, 4) for k in got if k[7] and (k[0] is None or k[0] == 7))
    assert all(got[(i, "x", "y", 1, "z", f"own {i}\nown two {i}", 6, 4)] == 1 for i in range(20, 60))


# --- op6 ---


def test_bounds_never_rule_out_a_link():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 24))
    x = centres[rng.integers(0, 12, 700)] + rng.normal(size=(700, 24)) * 0.33 * rng.random((700, 1)) * 2
    codes, scale, error, unit = vectors.quantise(x)
    links = unit @ unit.T >= 0.9
    half = (codes[:300], scale[:300], error[:300]), (codes[300:], scale[300:], error[300:])
    maybe = vectors.possible(*half, 0.9)
    assert not (links[:300, 300:] & ~maybe).any() and maybe.sum() < 2 * links[:300, 300:].sum() + 100


@pytest.mark.parametrize("tile", [64, 100_000])
def test_links_and_components_by_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(vectors, "TILE", tile)
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(9, 16))
    x = (centres[rng.integers(0, 9, 400)] + rng.normal(size=(400, 16)) * 0.3).astype(np.float32)
    x[390:] = x[5]
    data = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vectors.linked_vectors(data).collect()}
    y = x.astype(float)
    cos = y @ y.T / np.outer(np.linalg.norm(y, axis=1), np.linalg.norm(y, axis=1))
    near = cos >= 0.9
    root = list(range(400))
    for _ in range(400):
        new = [min(root[j] for j in np.flatnonzero(near[i])) for i in range(400)]
        if new == root:
            break
        root = new
    assert got == {i: (int(near[i].sum()) - 1, root[i], root[i] == i) for i in range(400)}


def test_odd_vectors_link_with_nothing(spark, folder):
    got = {(r["vec_id"], r["n_links"], r["component_id"]) for r in vectors.op6_embedding_links(spark, folder).collect()}
    assert {(1, 2, 1), (2, 2, 1), (3, 2, 1), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 0, 8), (9, 0, 9), (None, 0, None), (1, 0, 1)} == got


# --- op7 ---


def test_mix_meets_its_targets(spark):
    rng = np.random.default_rng(9)
    data = [(i, f"s{i % 4 if i % 3 else 0}", int(rng.integers(0, 60))) for i in range(3000)]
    items = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "item long, doc_id long, source string, size long")
    got = mixing.fair_queue(items).collect()
    again = {r["item"]: r["copies"] for r in mixing.fair_queue(items).collect()}
    assert again == {r["item"]: r["copies"] for r in got}
    taken, target, size = collections.Counter(), {}, {}
    for r in got:
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]], size[r["source"]] = r["target"], r["source_size"]
        assert 0 <= r["copies"] <= 2
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    assert all(abs(taken[s] - target[s]) <= 120 and target[s] <= 2 * size[s] for s in target)


def test_rows_without_an_id_and_finish_times_are_spread(spark):
    items = spark.range(100_000).select(
        F.col("id").alias("item"), F.lit(None).cast("long").alias("doc_id"), F.lit("s").alias("source"),
        (F.col("id") % 50 + 1).alias("size"), F.xxhash64("id").alias("tie"))
    places = items.select(F.floor(mixing.shuffle_key(F.col("doc_id"), F.concat_ws(":", "size", "tie")) / F.lit(float(1 << 60)) * 10).alias("p"))
    counts = [r["count"] for r in places.groupBy("p").count().collect()]
    assert len(counts) == 10 and max(counts) < 11_000
    # two sources, one of which is cut at its cap: each range of the merged order has its share
    rows = spark.range(9_000).select(
        F.when(F.col("id") % 9 == 0, "a").otherwise("b").alias("source"), F.lit(2).alias("size"), F.when(F.col("id") % 9 == 0, 2000).otherwise(16000).alias("source_size"),
        F.when(F.col("id") % 9 == 0, 4000.0).otherwise(9000.0).alias("target"))
    steps = mixing.finish_shares(rows, 2)
    ends = [F.lit(t) for t in (0.0, 0.25, 0.5, 0.75, 1.0, 2.0, 3.5, 9.9)]
    at = spark.range(1).select(*[mixing.evenly(e, steps).alias(f"c{i}") for i, e in enumerate(ends)]).first()
    want = [(min(t * 2, 2) * 1000 + min(t / 16 * 9, 2) * 8000) / 18000 for t in (0.0, 0.25, 0.5, 0.75, 1.0, 2.0, 3.5, 9.9)]
    assert list(at) == pytest.approx(want, abs=1e-3)


# --- op8 ---


def test_label_model_finds_accuracies_and_discounts_echoes():
    rng = np.random.default_rng(8)
    y = rng.random(6000) < 0.2
    right = lambda p: np.where(rng.random(6000) < p, np.where(y, 1, -1), np.where(y, -1, 1))
    a, b, c = right(0.95), right(0.8), right(0.5)
    votes = np.stack([a, a, b, c], axis=1)
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    known = np.zeros((len(patterns), 2))
    np.add.at(known, (inverse[:600], y[:600].astype(int)), 1)
    weights, bias = toxicity.fit_label_model(patterns, counts.astype(float), known, 0.2)
    assert weights[3] < 0.3 and weights[0] == pytest.approx(weights[1]) and weights[0] > weights[3]
    found = toxicity.posterior(patterns, weights, bias)[inverse] > 0.5
    assert (found == y).mean() > 0.93


def test_scores_on_held_out_documents(spark):
    rows = toxicity.op8_toxicity(spark, "/root/testdata/sf0.01").alias("s").join(
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang = 'en'").select("doc_id"), "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["toxic"] for r in rows)
    assert right >= 0.95 * len(rows) and all(0 <= r["score"] <= 1 for r in rows)


def test_all_labels_outside_the_fold_are_mined(spark, monkeypatch):
    class Seen(Exception):
        pass

    def seen(texts):
        raise Seen(texts.count())

    monkeypatch.setattr(toxicity, "mine", seen)
    docs = spark.range(15_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 20 == 0).cast("int").alias("toxic"))
    with pytest.raises(Seen) as found:
        toxicity.fit(docs, labels)
    outside = docs.where(~toxicity.held_out(F.col("doc_id"))).count()
    assert found.value.args == (outside,) and outside > 9_000


# --- op9 ---


@pytest.mark.parametrize("around", [
    "<aside><p>Note</aside>", "<nav><ul><li>Home</nav>", "<form><p>Search<input></form>", "<noscript><p>Note</noscript>",
    "<footer><div><p>Note</footer>", "<p>Text<aside><p>Note</aside>", "<dialog><table><tr><td>Note</dialog>"])
def test_what_surrounds_ends_with_its_end_tag(around):
    body = "<p>The article has a sentence of many words in it.<p>And it has a second one that is as long."
    for page in (f"<body><div>{around}{body}</div>", f"<head><title>T</title><body><div>{around}{body}</div>"):
        text = extract.main_text(page)
        assert "many words" in text and "as long" in text and "Note" not in text and "Home" not in text and "Search" not in text


@pytest.mark.parametrize("start", ["<head>", "<html><head><title>T</title>", "<head><meta charset=utf-8><style>p{}</style><noscript><img></noscript>"])
def test_the_head_ends_where_content_begins(start):
    for first, later in (("<p>", ""), ("", ""), ("<div>", "</div></head><body><p>And more.")):
        page = f"{start}{first}The article has a sentence.{later}"
        assert extract.main_text(page).startswith("The article has a sentence.")
        assert "The article" in warc.page_parts(page)[2]


PAGE = """<html><head><title>x</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><a href=1>Home</a></nav>
<div id="wrap"><div class="sidebar"><ul><li><a href=2>Old post one two three</a></ul></div><div class="post-content"><h2>My &eacute; title</h2>
<p>First para with  a lot of text that goes on and on, certainly.<p>Second one, <a href=3>with link</a>, also long enough to count here.
<ul><li>item one<li>item two</ul><div class="share">Tweet</div><form><input><label>Mail</label></form></div>
<div id="comments"><h3>Comments</h3><div class="comment"><p>I really liked this very long comment which has many words in it, so many words.</p></div></div></div>
<div class="cookie-notice">We use cookies</div><footer>c 2020</footer></body></html>"""


def test_article_without_what_surrounds_it():
    assert extract.main_text(PAGE) == (
        "My é title\nFirst para with a lot of text that goes on and on, certainly.\nSecond one, with link, also long enough to count here.\nitem one\nitem two")
    assert extract.main_text(None) == extract.main_text("") == extract.main_text("<nav>menu</nav>") == ""
    assert extract.main_text("<div>" * 5000 + "deep") == "deep" and extract.main_text("<p>a<br>b &lt; c") == "a b < c"


PROSE = "This sentence of the article is long enough to count as prose, and it goes on for a while."


def test_names_do_not_take_chapters_out_of_an_article():
    def p(k):
        return f"<p>{PROSE} {k}</p>"
    inside = f"<h1>T</h1>{p(1)}<section id='discussion'>{p(2)}</section><div class='related-work'>{p(3)}</div><p class='alert'>{PROSE} 4</p>"
    noise = "<div class='comments'><p>first!</p></div><div class='ad'>buy</div><div class='notice'>we moved</div>"
    want = "\n".join(["T"] + [f"{PROSE} {k}" for k in (1, 2, 3, 4)])
    assert extract.main_text(f"<nav>menu</nav><article>{inside}{noise}</article><div class='sidebar'>more</div>") == want
    assert extract.main_text(f"<div class='alert'>old browser</div><div id='main'>{inside}{noise}</div>") == want
    # reader comments of any name and length are not the article
    for name in ("responses", "user-posts", "comments"):
        assert extract.main_text(f"<article>{p(1)}</article><ul class='{name}'>{''.join(f'<li>{p(k)}</li>' for k in range(30))}</ul>") == f"{PROSE} 1"
    assert extract.main_text(f"<article>{p(1)}<article class='comment'>{p(2)}</article></article>") == f"{PROSE} 1"


def test_a_form_around_the_page_is_a_wrapper_and_a_heading_before_the_text_stays():
    page = f"<body><form action='/'><input name='state'><label>Find</label><select><option>a</option></select><h1>T</h1><p>{PROSE}</p><p>{PROSE}</p><button>Go</button></form></body>"
    assert extract.main_text(page) == f"T\n{PROSE}\n{PROSE}"
    assert extract.main_text(f"<form>Sign up<input></form><p>{PROSE}</p>") == PROSE
    beside = f"<body><h1>Title</h1><div class='c'><p>{PROSE}</p><p>{PROSE}</p></div><div><a href='x'>one</a> <a href='y'>two</a></div></body>"
    assert extract.main_text(beside) == f"Title\n{PROSE}\n{PROSE}"


# --- op10 ---


def test_signatures_agree_like_weighted_jaccard():
    rng = np.random.default_rng(10)
    differences = []
    for _ in range(25):
        a, b = (np.unique(np.concatenate([shared, rng.integers(1, 2**62, 40).astype(np.uint64)])) for shared in [rng.integers(1, 2**62, 200).astype(np.uint64)] * 2)
        wa, wb = rng.integers(1, 9, len(a)).astype(float), rng.integers(1, 9, len(b)).astype(float)
        both = np.isin(b, a)
        wb[both] = wa[np.isin(a, b)]
        differences.append((minhash.signature(a, wa) == minhash.signature(b, wb)).mean() - minhash.similarity((a, wa), (b, wb)))
    assert abs(np.mean(differences)) < 0.03


def test_blocks_compare_exactly():
    texts = [BASE, BASE.replace("t30", "x"), BASE + " " + BASE, "one two", "other words only here today ok"]
    block, sets = minhash.Block(texts), [minhash.shingles(t) for t in texts]
    for i in range(5):
        assert block.similar(i, np.arange(5)) == pytest.approx([minhash.similarity(sets[i], s) for s in sets])


@pytest.mark.parametrize("block", [8, 2048])
def test_classes_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = np.random.default_rng(11)
    base = [f"v{i}" for i in range(120)]
    texts = []
    for _ in range(60):  # copies of copies: some pairs reach 0.8, others only by way of third ones
        words = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 6)):
            words[at] = f"n{rng.integers(0, 30)}"
        texts.append(" ".join(words))
    texts += texts[:5] + ["a b", "a b", "", "c d e f g h", "c d e f g i"]
    data = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(data).collect()}
    sets, root = [minhash.shingles(t) for t in texts], list(range(len(texts)))
    near = [[j for j in range(len(texts)) if i == j or minhash.similarity(sets[i], sets[j]) >= 0.8] for i in range(len(texts))]
    for _ in texts:
        root = [min(root[j] for j in near[i]) for i in range(len(texts))]
    assert got == dict(enumerate(root))


def test_components_of_a_long_path(spark):
    from llm.graph import components

    links = spark.range(1, 200).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b")).unionAll(spark.createDataFrame([(500, 501), (501, 501)], "a long, b long"))
    got = {r["node"]: r["root"] for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(200)}, 500: 500, 501: 500}


def test_one_document_of_each_class_stays(spark, docs):
    kept = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in minhash.near_duplicate_stage(spark, docs, "").collect())
    ids = [i for none, i in kept if not none]
    assert 1 in ids and 2 not in ids and 3 not in ids and ids.count(7) == 1 and (True, 0) in kept and {4, 5, 11} <= set(ids)


def test_a_response_pays_for_each_digest_once_and_for_no_names(monkeypatch):
    hashed, digest = [], warc.digest
    monkeypatch.setattr(warc, "digest", lambda data: hashed.append(data) or digest(data))
    monkeypatch.setattr(extract, "_said", lambda names: pytest.fail(f"class names are not asked for: {names}"))
    page = '<title>A</title><div class="menu">One\u2003 two\x1f<a href="/x">three</a></div><p>Four</p>'
    meta, text = warc.derive("<urn:x>", "http://a/", None, "text/html", page)
    assert len(hashed) == 4 and text[10] == "One two three\nFour" and text[7] == digest(text[10].encode())
    assert f"WARC-Block-Digest: {meta[7]}\r\n" in meta[9] and '"links": ["/x"]' in meta[10]
