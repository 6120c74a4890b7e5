"""All pairs of vectors above a cosine, by int8 tile products with error bounds.

A unit vector x is stored as int8 codes q and a scale s. With e = |x - s q|, two vectors obey
|x.y - s t q.r| <= e_x + e_y + e_x e_y, so a product of codes rules a pair out for certain unless it lies
within that bound of the threshold; the pairs that remain are computed again in double precision.

Exact copies are one vector with a count. Vectors live in the cell of their best pivot; links are
sought in a vector's own cell and in the cells its distance to the pivots' bisecting planes cannot
rule out. Cells of any size are cut into tiles, and a task gets one pair of tiles. From a pair of
tiles come sums and a spanning forest of its links, never the links themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import table
from llm.graph import components
from ticketloom.session import written

COSINE = 0.9
#: Vectors of a tile and of a cell on average; pivots, a sample of the vectors, are at most MAX_CELLS.
TILE, MAX_CELLS = 2048, 256
#: Pairs computed again in double precision at a time.
AGAIN = 50_000


def comparable(embedding: Column) -> Column:
    """Neither null, empty, zero nor with null or non-finite components."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(embedding.isNotNull() & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of doubles -> int8 codes, scales, error norms and the unit vectors."""
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    scale = np.abs(x).max(axis=1) / 127
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    rest = x - scale[:, None] * codes
    return codes, scale, np.sqrt((rest * rest).sum(axis=1)) + 1e-12, x


def possible(left: tuple, right: tuple, cosine: float) -> np.ndarray:
    """Which pairs of (codes, scale, error) rows may reach ``cosine``. Sums of products of codes are exact in 32-bit floats."""
    (q, s, e), (r, t, d) = left, right
    out = q.astype(np.float32) @ r.astype(np.float32).T
    out *= s.astype(np.float32)[:, None]
    out *= t.astype(np.float32)
    bound = (e[:, None] + e[:, None] * d[None, :]).astype(np.float32)
    bound += d.astype(np.float32)
    out += bound
    return out >= np.float32(cosine - 1e-5)


def _roots(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Smallest label that links ``a, b`` connect each of n places to; ``label`` is updated."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def tile_links(left: pd.DataFrame, right: pd.DataFrame | None, dim: int, cosine: float) -> pd.DataFrame:
    """Links of a pair of tiles (or, without ``right``, of one with itself): per vector ``node, links, root``."""
    both = left if right is None else pd.concat([left, right], ignore_index=True)
    nodes, copies = both["node"].to_numpy(), both["copies"].to_numpy()
    codes = np.frombuffer(b"".join(both["codes"]), np.int8).reshape(-1, dim)
    full = np.frombuffer(b"".join(both["vector"]), np.float64).reshape(-1, dim)
    scale, error = both["scale"].to_numpy(), both["error"].to_numpy()
    n, start = len(left), 0 if right is None else len(left)
    links, label = np.zeros(len(both), np.int64), np.arange(len(both))
    norms = np.sqrt((full * full).sum(axis=1))
    for at in range(0, n, 512):
        rows = slice(at, min(at + 512, n))
        first = rows.start + 1 if right is None else start
        if first >= len(both):
            continue
        hits = possible((codes[rows], scale[rows], error[rows]), (codes[first:], scale[first:], error[first:]), cosine)
        i, j = np.nonzero(hits)
        i, j = i + rows.start, j + first
        if right is None:
            i, j = i[j > i], j[j > i]
        for some in range(0, len(i), AGAIN):
            a, b = i[some:some + AGAIN], j[some:some + AGAIN]
            linked = np.einsum("ij,ij->i", full[a], full[b]) / (norms[a] * norms[b]) >= cosine
            a, b = a[linked], b[linked]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            label = _roots(len(both), a, b, label)
    some = links > 0
    return pd.DataFrame({"node": nodes[some], "links": links[some], "root": nodes[label[some]]})


def _placed(vectors: DataFrame, pivots: dict[int, np.ndarray], cosine: float) -> DataFrame:
    """``node, copies, embedding`` -> codes and a row per cell that the vector lives in (``home``) or has to visit.

    If a's best pivot is p, then a.(r - p) <= 0 for every pivot r; with |a - b| <= reach a link to b needs
    b.(r - p) <= reach |r - p|. A pair of cells is handled in the one that comes first.
    """
    reach = math.sqrt(2 - 2 * cosine)
    between = {d: np.sqrt(np.maximum(0, ((p[:, None] - p[None]) ** 2).sum(axis=2))) for d, p in pivots.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                lists = part.column("embedding")
                dims = np.diff(lists.offsets.to_numpy())
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                for dim in np.unique(dims).tolist():
                    places = np.flatnonzero(dims == dim)
                    values = flat[(lists.offsets.to_numpy()[places] - lists.offsets[0].as_py())[:, None] + np.arange(dim)]
                    codes, scale, error, x = quantise(values)
                    if dim in pivots:
                        dots = x @ pivots[dim].T
                        home = dots.argmax(axis=1)
                        visits = np.ones(dots.shape, dtype=bool)
                        for best in np.argsort(-dots, axis=1)[:, :8].T:  # the tightest planes
                            ahead = dots[np.arange(len(x)), best][:, None] - dots
                            visits &= ahead <= reach * between[dim][best] + 1e-9
                        visits &= np.arange(dots.shape[1])[None, :] <= home[:, None]
                    else:
                        home, visits = np.zeros(len(x), np.int64), np.ones((len(x), 1), dtype=bool)
                    row, cell = np.nonzero(visits)
                    take = pa.array(places[row])
                    yield pa.RecordBatch.from_arrays([
                        part.column("node").take(take), part.column("copies").take(take), pa.array(np.full(len(row), dim, np.int32)),
                        pa.array(cell.astype(np.int32)), pa.array(cell == home[row]),
                        pa.array([codes[r].tobytes() for r in row], pa.binary()), pa.array(scale[row]), pa.array(error[row]),
                        pa.array([values[r].tobytes() for r in row], pa.binary())],
                        names=["node", "copies", "dim", "cell", "home", "codes", "scale", "error", "vector"])

    return vectors.select("node", "copies", "embedding").mapInArrow(run, (
        "node long, copies long, dim int, cell int, home boolean, codes binary, scale double, error double, vector binary"))


def cosine_links(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``node, copies, embedding`` (stored, distinct, comparable) -> stored ``node, links, root`` per pair of tiles with links."""
    sizes = vectors.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count")).limit(4).collect()
    pivots = {}
    for r in sizes:  # a bounded sample, at most 4 x MAX_CELLS vectors; other lengths share one cell each
        cells = min(MAX_CELLS, r["count"] // TILE)
        if cells > 1:
            chosen = vectors.where(F.size("embedding") == r["dim"]).orderBy(F.xxhash64("node")).limit(cells).collect()
            pivots[r["dim"]] = quantise(np.array([c["embedding"] for c in chosen], dtype=np.float64))[3]
    placed = written(_placed(vectors, pivots, cosine), "vector-cells")
    # tiles of each cell: a row per cell, at most (MAX_CELLS x 4 + lengths)
    per = lambda own: F.greatest(F.lit(1), F.ceil(F.count_if(own) / TILE))
    tiles = placed.groupBy("dim", "cell").agg(per(F.col("home")).alias("homes"), per(~F.col("home")).alias("visitors"))
    rows = placed.join(tiles, ["dim", "cell"]).withColumn("tile", F.pmod(F.xxhash64("node"), F.when(
        F.col("home"), F.col("homes")).otherwise(F.col("visitors"))))
    to = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    pair = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    own = F.transform(to("homes"), lambda k: pair("own", F.least("tile", k), F.greatest("tile", k)))
    guests = F.transform(to("visitors"), lambda k: pair("guests", F.col("tile"), k))
    hosts = F.transform(to("homes"), lambda k: pair("guests", k, F.col("tile")))
    pairs = rows.withColumn("pair", F.explode(F.when(F.col("home"), F.concat(own, guests)).otherwise(hosts)))

    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        dim, _, kind, i, j = key
        if kind == "own" and i == j:
            return tile_links(group, None, dim, cosine)
        right = group["tile"] == j if kind == "own" else ~group["home"]
        if right.all() or not right.any():
            return pd.DataFrame({"node": [], "links": [], "root": []}).astype("int64")
        return tile_links(group[~right], group[right], dim, cosine)

    out = pairs.select("dim", "cell", "pair.*", "tile", "home", "node", "copies", "codes", "scale", "error", "vector")
    return written(out.groupBy("dim", "cell", "kind", "i", "j").applyInPandas(
        compare, "node long, links long, root long"), "vector-links")


def linked_vectors(rows: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``vec_id, embedding`` -> a row per vector: vec_id, n_links, component_id, kept.

    Vectors that are not comparable, and vectors of different lengths, link with nothing. Repeated ids are
    rows of their own; a null id takes part and is never a component's id unless no other is there.
    """
    rows = written(rows.select(F.monotonically_increasing_id().alias("row_id"), "vec_id", "embedding"), "vector-rows")
    good = rows.where(comparable(F.col("embedding"))).select(
        "row_id", "vec_id", F.struct(F.xxhash64("embedding"), F.xxhash64(F.lit(1), "embedding")).alias("key"))
    copies = written(good.groupBy("key").agg(F.min("row_id").alias("node"), F.count(F.lit(1)).alias("copies")), "vector-copies")
    vectors = written(rows.select(F.col("row_id").alias("node"), "embedding").join(copies.select("node", "copies"), "node"), "vectors")
    found = cosine_links(vectors, cosine)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    owned = rows.select("row_id", "vec_id").join(good.join(copies, "key").select("row_id", "node", "copies"), "row_id", "left").withColumn(
        "node", F.coalesce("node", "row_id")).join(links, "node", "left").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    owned = written(owned, "vector-owned")
    least = owned.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    return owned.join(least, "root").select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"), "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op6_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every row of ``embeddings``, whatever its label."""
    return linked_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_sum(list_transform(a.e, lambda x: x * x)) > 0 AND list_sum(list_transform(b.e, lambda x: x * x)) > 0
    AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
"""
