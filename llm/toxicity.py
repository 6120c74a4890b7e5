"""Toxicity by weak supervision.

1. Voters. Lexicon voters look for insults and hostile phrases; pattern voters look for shouting, stretched
   letters and the like; learned voters look for groups of letter sequences that training labels mark as
   toxic. Each votes toxic, not toxic, or abstains, on every document.
2. Label model. The vote patterns of all documents are counted, which is all that a generative model needs: a
   hidden label, an accuracy and a coverage per voter, fitted by expectation-maximisation. Pairs of voters that
   still agree more than their accuracies explain are correlated; their votes share one weight.
3. Classifier. A logistic regression on hashed letter sequences and on the voters that words move learns the posterior labels of a bounded sample of
   documents and scores whole texts. Training labels fix its offset and scale.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import table
from ticketloom.session import written

#: Texts that the classifier is fitted on at most.
FIT_ROWS = 6_000
#: Hashed features, and those of them that the classifier weighs.
FEATURES, CHOSEN = 1 << 18, 3_000
#: Voters that single tokens move: five lexicons and three mined groups. The next bit marks tokens with a stretched letter.
VOTING = 8
STRETCHED = 1 << VOTING
THRESHOLD = 0.7
HELD_OUT, FOLDS = 1, 3

_TOKEN = re.compile(r"[^\W\d_]+")
INSULTS = frozenset("idiot idiots moron morons stupid dumb loser losers scum trash garbage worthless pathetic clown fool fools jerk".split())
CONTEMPT = frozenset("disgusting vile filthy despicable useless hateful ugly hate hated shameful coward cowards liar liars".split())
THREATS = frozenset("kill die destroy hurt punch burn beat stab shoot".split())
PROFANE = frozenset("damn hell crap bastard bastards bitch shit fuck fucking ass asshole".split())
FOREIGN = frozenset((
    "dumm idiot trottel arschloch abschaum scheisse scheiße verdammt "
    "stupide idiote imbécile connard ordure merde salaud "
    "estúpido idiota imbécil basura mierda asqueroso cabrón").split())
_SHOUT = re.compile(r"\b[A-ZÀ-Þ]{4,}\b.*!", re.S)
_STRETCHED = re.compile(r"([^\W\d_])\1{3,}")
_ADDRESS = re.compile(r"\byou(?:'re| are)? (?:an? |such )?(?:idiot|moron|loser|fool|clown|stupid|pathetic|worthless)", re.I)
#: Names of the voters in the order of their votes; at most 3 ** 12 patterns of votes are possible.
VOTERS = ("insults", "contempt", "threats", "profane", "foreign", "shouting", "stretched", "address",
          "learned_0", "learned_1", "learned_2", "no_signal")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def tokens_of(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def grams(token: str) -> list[str]:
    """Letter sequences of four and five of a token, its start and end marked."""
    marked = f"^{token}$"
    n = len(marked)
    return [marked[i:i + 4] for i in range(n - 3)] + [marked[i:i + 5] for i in range(n - 4)]


class PerToken(dict):
    """What ``of`` says of a token, remembered within a bound."""

    def __init__(self, of: Callable[[str], object], remembered: int = 600_000):
        super().__init__()
        self.of, self.remembered = of, remembered

    def __missing__(self, token: str) -> object:
        if len(self) > self.remembered:
            self.clear()
        value = self[token] = self.of(token)
        return value


def token_features(bits: PerToken) -> Callable[[str], list[int]]:
    """Features of a token: the voters it moves, then itself and its letter sequences by their hashes."""
    def of(token: str) -> list[int]:
        moved = bits[token]
        hashed = [feature(g) for g in (token, *grams(token))]
        return [i for i in range(VOTING) if moved >> i & 1] + hashed if moved else hashed
    return of


def feature(sequence: str) -> int:
    return VOTING + crc32(sequence.encode()) % (FEATURES - VOTING)


def weighed_features(groups: tuple[frozenset, ...], known: dict[str, int], used: frozenset) -> Callable[[str], tuple]:
    """Features of a token that have a weight, by the sequences of the fitting sample: no hash has to be taken."""
    masks, parts = vote_tables(groups)
    told = {g: (parts.get(g, 0), known.get(g)) for g in parts.keys() | known.keys()}

    def of(token: str) -> tuple:
        moved, found = masks.get(token, 0), []
        for g in (token, *grams(token)):
            hit = told.get(g)
            if hit is not None:
                moved |= hit[0] if g is not token else 0
                if hit[1] is not None:
                    found.append(hit[1])
        return (*(i for i in range(VOTING) if moved >> i & 1 and i in used), *found) if moved else tuple(found)
    return of


def features_of(text: str | None, features: PerToken) -> np.ndarray:
    """Distinct features of a text."""
    found: set[int] = set()
    for token in set(tokens_of(text)):
        some = features[token]
        if some:
            found.update(some)
    return np.fromiter(found, dtype=np.int32)


def mine(texts: DataFrame) -> list[str]:
    """Letter sequences that mark toxic training texts: ``text, toxic`` -> all that pass the test, the best first.

    Counted over all labelled training texts. As each is in at least 1 % of the toxic texts, there are at most a hundred
    times as many as a toxic text has on average, whatever the number of texts.
    """
    def total(counts: list[Counter]) -> pa.RecordBatch:
        found = list(counts[0].keys() | counts[1].keys())
        out = [pa.array(found, pa.string()), *(pa.array([c[g] for g in found], pa.int64()) for c in counts)]
        for c in counts:
            c.clear()
        return pa.RecordBatch.from_arrays(out, names=["gram", "clean", "bad"])

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [Counter(), Counter()]
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist(), strict=True):
                    counts[1 if toxic else 0].update({g for t in set(tokens_of(text)) for g in grams(t)})
                if len(counts[0]) > 400_000:
                    yield total(counts)
        yield total(counts)

    totals = texts.agg(F.count_if(F.col("toxic") == 0), F.count_if(F.col("toxic") == 1)).first()
    n_clean, n_bad = max(1, totals[0]), max(1, totals[1])
    counted = texts.select("text", "toxic").mapInArrow(explode, "gram string, clean long, bad long").groupBy("gram").agg(
        F.sum("clean").alias("clean"), F.sum("bad").alias("bad"))
    # a sequence counts if it is in at least 1 % of the toxic texts and 25 times likelier there
    lift = (F.col("bad") / n_bad) / ((F.col("clean") + 0.5) / n_clean)
    rows = counted.where((F.col("bad") >= F.lit(max(3, 0.01 * n_bad))) & (lift >= 25)).orderBy(
        F.desc(F.col("bad") * F.log(lift)), "gram").collect()
    return [r["gram"] for r in rows]


LEXICONS = (INSULTS, CONTEMPT, THREATS, PROFANE, FOREIGN)


def vote_tables(mined: tuple[frozenset, ...]) -> tuple[dict[str, int], dict[str, int]]:
    """Bits of the voters that lexicon words and mined sequences make vote."""
    masks = {word: 0 for words in LEXICONS for word in words}
    for i, words in enumerate(LEXICONS):
        masks |= {word: masks[word] | 1 << i for word in words}
    parts: dict[str, int] = {}
    for i, group in enumerate(mined):
        parts |= {g: parts.get(g, 0) | 1 << len(LEXICONS) + i for g in group}
    return masks, parts


def token_votes(mined: tuple[frozenset, ...]) -> PerToken:
    """Bits of the voters that a token makes vote: the lexicons, then the mined groups; and whether a letter is stretched."""
    masks, parts = vote_tables(mined)

    def of(token: str) -> int:
        found = masks.get(token, 0) | (STRETCHED if _STRETCHED.search(token) else 0)
        for g in grams(token) if parts else ():
            if g in parts:
                found |= parts[g]
        return found

    return PerToken(of)


def votes(text: str | None, bits: PerToken, mined: bool) -> tuple[int, ...]:
    """1 toxic, -1 not toxic, 0 abstain, in the order of ``VOTERS``."""
    text, n = text or "", len(LEXICONS)
    found, tokens = 0, set(tokens_of(text))
    for token in tokens:
        found |= bits[token]
    # what a pattern needs is looked for first: most texts have no such token, sign or word
    out = [found >> i & 1 for i in range(n)] + [
        int("!" in text and bool(_SHOUT.search(text))), int(bool(found & STRETCHED) and bool(_STRETCHED.search(text))),
        int("you" in tokens and bool(_ADDRESS.search(text)))]
    # learned voters speak either way, as they know what training texts look like
    out += [1 if found >> n + i & 1 else -1 if mined else 0 for i in range(3)]
    out.append(0 if any(v > 0 for v in out) else -1)
    return tuple(out)


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, known: np.ndarray, prior: float, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Distinct vote patterns, their counts and, of training texts, clean and toxic ones -> weights per voter and the bias.

    The model: a text is toxic with probability ``prior``; a voter that speaks is right with its own accuracy, and
    says nothing by keeping silent. Expectation-maximisation fits the accuracies on all texts, from a start on the
    training texts, which keep as much say as all the others; a voter below chance has no weight. What two voters have in common beyond the label is their correlation: a voter's weight is divided by
    one plus its correlations with the others, so that a group of echoes counts about once.
    """
    m, spoken = patterns.shape[1], patterns != 0
    bias = math.log(prior / (1 - prior))
    share = np.ones(m)
    known = known * (counts.sum() / max(known.sum(), 1.0))
    labelled = known.sum(axis=1)
    known_right = (known[:, :1] * (patterns < 0) + known[:, 1:] * (patterns > 0)).sum(axis=0)
    toxic, say = np.zeros(len(counts)), 0.0
    for step in range(rounds):
        right = np.where(patterns > 0, toxic[:, None], 1 - toxic[:, None]) * spoken
        accuracy = (say * counts @ right + known_right + 1) / ((say * counts + labelled) @ spoken + 2)
        weights = np.log(np.clip(accuracy, 0.5, 0.99)) - np.log(1 - np.clip(accuracy, 0.5, 0.99))
        if step % 10 == 0:
            corr = np.zeros((m, m))
            for w in (say * counts * toxic + known[:, 1], say * counts * (1 - toxic) + known[:, 0]):
                if w.sum() > 1:
                    x = patterns - (w @ patterns) / w.sum()
                    cov = (x * w[:, None]).T @ x / w.sum()
                    sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
                    corr += np.clip(cov / np.outer(sd, sd), 0, 1) * w.sum() / max((say * counts + labelled).sum(), 1.0)
            share = 1 / (1 + corr.sum(axis=1) - np.diag(corr))
        new = posterior(patterns, weights * share, bias)
        if np.abs(new - toxic).max() < 1e-7 and step > 20:
            break
        toxic, say = new, 1.0
    return weights * share, bias


def posterior(patterns: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(patterns @ weights + bias, -30, 30)))


def choose_features(sets: list[np.ndarray], target: np.ndarray) -> np.ndarray:
    """Features at least 4 times likelier in toxic texts: the top CHOSEN by log-likelihood ratio, in ascending order.

    What is merely rarer in toxic texts says nothing about a long one and is left out.
    """
    flat = np.concatenate([*sets, np.empty(0, np.int32)])
    weight = np.repeat(target, [len(s) for s in sets])
    pos, every = np.bincount(flat, weight, FEATURES), np.bincount(flat, minlength=FEATURES)
    n, p = len(sets), float(target.sum())

    def part(a: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(a > 1e-12, a * np.log(np.maximum(a, 1e-12) / np.maximum(expected, 1e-12)), 0)

    gain = sum(part(a, e) for a, e in (
        (pos, every * p / n), (every - pos, every * (n - p) / n), (p - pos, (n - every) * p / n),
        (n - p - every + pos, (n - every) * (n - p) / n)))
    best = np.argsort(-gain, kind="stable")[:CHOSEN]
    lift = (pos / max(p, 1e-9)) / ((every - pos + 0.5) / max(n - p, 1e-9))
    return np.sort(best[(gain[best] > 8) & (every[best] >= 3) & (lift[best] >= 4)])


def fit_linear(sets: list[np.ndarray], target: np.ndarray, rounds: int = 300, decay: float = 0.5) -> tuple[np.ndarray, float]:
    """Logistic regression on chosen features, present or not, against soft labels: accelerated gradient descent."""
    chosen = choose_features(sets, target)
    place = np.full(FEATURES, -1)
    place[chosen] = np.arange(len(chosen))
    held = [place[s][place[s] >= 0] for s in sets]
    row, col = np.repeat(np.arange(len(held)), [len(h) for h in held]), np.concatenate([*held, np.empty(0, np.int64)]).astype(np.int64)
    n, m = len(sets), len(chosen)
    x = np.zeros(m + 1)
    x[m] = math.log((target.sum() + 0.5) / (n - target.sum() + 0.5))
    # steps per feature by its count, over the most features that a row has: a bound on the curvature
    scale = 1 / (np.bincount(col, minlength=m) + decay) if m else np.empty(0)
    last, look, t = x.copy(), x.copy(), 1.0
    widest = max([len(h) for h in held], default=0) + 1
    for _ in range(rounds):
        z = np.bincount(row, look[col], n) + look[m]
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - target
        grad = np.bincount(col, error[row], m) + decay * look[:m]
        x = look.copy()
        x[:m] -= 4 / widest * scale * grad
        x[m] -= 4 / widest * error.sum() / n
        ahead = (1 + math.sqrt(1 + 4 * t * t)) / 2
        look, last, t = x + (t - 1) / ahead * (x - last), x, ahead
    w = np.zeros(FEATURES)
    w[chosen] = x[:m]
    return w, float(x[m])


def linear(w: np.ndarray, bias: float, features: np.ndarray) -> float:
    return float(w[features].sum()) + bias


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """One text per id of a bounded, distinct set of ids, which is broadcast: of rows that share the id, the smallest text."""
    rest = [F.first(c).alias(c) for c in docs.columns if c not in ("doc_id", "text")]
    return docs.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), *rest)


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """``doc_id, text`` and ``doc_id, toxic`` -> the fitted model, a few hundred kB.

    Only labels of ids outside the held-out fold are read, and all of those: they mine the voters, give the prior
    and start the label model. An id with several labels is toxic if one says so; all rows of a labelled id count.
    """
    some = lambda df, n: df.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    marks = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id"))).groupBy(
        "doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    # the same plan at every size: texts are shuffled by id
    marked = written(docs.join(marks.hint("merge"), "doc_id").select("doc_id", "text", "toxic"), "toxic-marked")
    found = mine(marked)
    groups = tuple(frozenset(found[k::3]) for k in range(3))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = token_votes(groups)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                cast = [json.dumps(votes(t, bits, bool(found))) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(cast, pa.string())], names=["doc_id", "pattern"])

    # every document votes, once; at most 3 ** voters patterns come back, in practice some hundred
    id_type = docs.schema["doc_id"].dataType.simpleString()
    ballots = written(docs.select("doc_id", "text").mapInArrow(vote, f"doc_id {id_type}, pattern string"), "toxic-votes")
    counted = sorted((json.loads(r["pattern"]), r["n"]) for r in ballots.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect())
    marks_of = {r["pattern"]: (r["clean"], r["toxic"]) for r in ballots.join(marks, "doc_id").groupBy("pattern").agg(
        F.sum(1 - F.col("toxic")).alias("clean"), F.sum("toxic").alias("toxic")).collect()}
    share = marked.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    prior = min(max(share if share is not None else 0.05, 0.001), 0.5)
    if not counted:
        return {"w": np.zeros(FEATURES, np.float32), "bias": -5.0, "scale": 1.0, "offset": 0.0, "groups": groups, "known": {}}
    patterns = np.array([p for p, _ in counted])
    known = np.array([marks_of.get(json.dumps(p), (0, 0)) for p, _ in counted], dtype=float)
    weights, bias = fit_label_model(patterns, np.array([c for _, c in counted], dtype=float), known, prior)
    soft = dict(zip([json.dumps(p) for p, _ in counted], posterior(patterns, weights, bias).tolist(), strict=True))
    # the fitting sample: labelled texts, which also set offset and scale, and any texts
    any_ids = some(docs.where("doc_id is not null").select("doc_id").distinct(), FIT_ROWS // 3)
    marked_ids = some(marked.select("doc_id").distinct(), FIT_ROWS - FIT_ROWS // 3)
    sample = written(_texts(marked, marked_ids).select("doc_id", "text", "toxic").unionByName(
        _texts(docs, any_ids).select("doc_id", "text", F.lit(None).cast("int").alias("toxic"))), "toxic-fitting")

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = token_votes(groups)
        features = PerToken(token_features(bits), 50_000)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                texts = part.column("text").to_pylist()
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("toxic"), pa.array([soft[json.dumps(votes(t, bits, bool(found)))] for t in texts]),
                    pa.array([features_of(t, features).tobytes() for t in texts], pa.binary())],
                    names=["doc_id", "toxic", "soft", "features"])

    sets = written(sample.mapInArrow(featurise, f"doc_id {id_type}, toxic int, soft double, features binary"), "toxic-sample")

    def train(group: pd.DataFrame) -> pd.DataFrame:  # one task, FIT_ROWS rows at most
        group = group.sort_values(["doc_id", "toxic"])
        sets = [np.frombuffer(f, dtype=np.int32) for f in group["features"]]
        w, b = fit_linear(sets, group["soft"].to_numpy())
        z = np.array([linear(w, b, f) for f in sets])
        known = group["toxic"].notna().to_numpy()
        scale, offset = calibrate(z[known], group["toxic"][known].to_numpy(dtype=float))
        return pd.DataFrame({"w": [w.astype(np.float32).tobytes()], "bias": [b], "scale": [scale], "offset": [offset]})

    fitted = sets.groupBy(F.lit(0).alias("one")).applyInPandas(train, "w binary, bias double, scale double, offset double").first()
    if fitted is None:
        return {"w": np.zeros(FEATURES, np.float32), "bias": -5.0, "scale": 1.0, "offset": 0.0, "groups": groups, "known": {}}
    w = np.frombuffer(fitted["w"], np.float32)
    used = frozenset(np.flatnonzero(w).tolist())

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = set().union(*(tokens_of(t) for t in batch.column("text").to_pylist()))
            sequences = {g for t in tokens for g in (t, *grams(t))}
            yield pa.RecordBatch.from_arrays([pa.array([g for g in sequences if feature(g) in used], pa.string())], names=["sequence"])

    # the sequences of the sample behind the features that have a weight: bounded as the sample is
    known = {r["sequence"]: feature(r["sequence"]) for r in sample.select("text").mapInArrow(spell, "sequence string").distinct().collect()}
    return {"groups": groups, "w": w, "known": known, **{k: fitted[k] for k in ("bias", "scale", "offset")}}


def calibrate(z: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Scale and offset that make the logistic function of ``scale * z + offset`` fit labels; the threshold falls amid the best cut."""
    if not len(z) or toxic.min() == toxic.max():
        return 1.0, 0.0
    order = np.argsort(-z, kind="stable")
    hits, misses = np.cumsum(toxic[order]), np.cumsum(1 - toxic[order])
    f1 = 2 * hits / (hits + misses + toxic.sum())
    # among the cuts that are nearly the best, the one in the widest gap
    gaps = z[order] - np.append(z[order][1:], z[order][-1] - 1.0)
    best = int(np.argmax(np.where(f1 >= f1.max() - 0.01, gaps, -1.0)))
    cut, spread = float(z[order[best]] - gaps[best] / 2), max(float(np.std(z)), 1e-6)
    scale = 2.0 / spread
    return scale, float(np.log(THRESHOLD / (1 - THRESHOLD)) - scale * cut)


def scored(rows: DataFrame, model: dict) -> DataFrame:
    """``doc_id, text, ...`` -> the same with ``score``, from 0 to 1, over whole texts. Null and empty texts have no features."""
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w = model["w"].astype(np.float64)
        used = frozenset(np.flatnonzero(w).tolist())
        features = PerToken(weighed_features(model["groups"], model["known"], used))
        for series in texts:
            z = np.array([linear(w, model["bias"], features_of(t, features)) for t in series])
            yield pd.Series(1 / (1 + np.exp(-np.clip(model["scale"] * z + model["offset"], -30, 30))))

    run.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return rows.withColumn("score", F.pandas_udf(run, "double")(F.col("text")))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and prediction of every document. Repeated rows score alike; a null id is not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return scored(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
