"""Columns that the optimizer computes once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns behind a generator of exactly one row.

    A filter moves below a projection by copying the expressions it needs, so an expensive column
    would be computed for the filter and again for the output. Filters never move below a
    generator, so here each row pays once. The generator is part of the same codegen stage.
    """
    if len(columns) == 1:
        (name, value), = columns.items()
        return df.select("*", F.explode(F.array(value)).alias(name))
    return df.select("*", F.inline(F.array(F.struct(*[v.alias(n) for n, v in columns.items()]))))
