"""JSON text as VARIANT, also where the strict parser refuses it.

A tracker may repeat a name in an object or write ``NaN`` and infinities. Of repeated names the last one wins, by a
setting of the session, as Spark has no option of one call for it. Numbers that are none go to a second reader, which sees
only what the first one refuses. What is no JSON stays unreadable.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_STRICT = {"allowSingleQuotes": "false"}


def last_name_wins(spark: SparkSession) -> None:
    """Let this session's VARIANT parsers take the last of repeated names, as JSON readers of most languages do.

    It has to hold while a plan runs, so it stays set; a stream takes it along when it starts.
    """
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def _one_value(text: Column) -> Column:
    """Is the whole text one value? ``from_json`` ignores what follows a value, unless an array goes on after it."""
    return F.size(F.from_json(F.concat(F.lit("["), text, F.lit(",0]")), "array<string>", _STRICT)) == 2


def parse_document(value: Column) -> Column:
    """JSON text as VARIANT: by the strict parser, else by the reader that knows ``NaN``, else null."""
    return F.coalesce(F.try_parse_json(value), F.when(_one_value(value), F.from_json(value, "variant", _STRICT)))
