"""Connected components of a graph of links, in rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.session import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``a, b`` (longs, any order) -> ``node, root``: the smallest node that each linked node can reach.

    Alternating large-star and small-star steps: every node hands its larger neighbours, then its
    smaller ones, to the smallest node it knows. The links become stars around the roots in a number of
    rounds that grows with the logarithm of the longest path. Each round is written to the shared
    folder, which also cuts the lineage; a node with many links is summed up before the shuffle, and the
    joins on it can be split.
    """
    edges = written(links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(large.distinct(), "large-star")
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        small = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            low.select("u", F.col("m").alias("v")))
        edges = written(small.distinct(), "small-star")
        now = _state(edges)
        if now == state:
            break
        state = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionAll(stars.select(F.col("root").alias("node"), "root").distinct())


def _state(edges: DataFrame) -> tuple:
    """A few numbers that change whenever the set of links does."""
    return tuple(edges.agg(
        F.count(F.lit(1)), F.sum(F.col("v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("u", "v"))).first())
