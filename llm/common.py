"""What several operators share: reading tables, keys of texts and rows, words, 64-bit mixing."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but the ASCII space and the controls from tab to carriage return.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SQL_WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(df: DataFrame) -> Column:
    """128 bits of a whole row, as text: rows that share it are the same in every column."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    return F.concat_ws(":", F.xxhash64(F.lit(1), *columns), F.xxhash64(F.lit(2), *columns))


def n_words(text: Column) -> Column:
    """Words of a whole text as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(SQL_WORD)), F.lit(0)).cast("long")


def content_key(text: Column) -> Column:
    """128 bits of a text, as 16 bytes."""
    return F.unhex(F.md5(text))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit numbers (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))  # an array of its own, which the rest changes in place
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def unit(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as doubles in [0, 1)."""
    return (x >> np.uint64(11)) * (1.0 / (1 << 53))
