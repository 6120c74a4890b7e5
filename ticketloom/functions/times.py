"""Timestamp expressions. Values are TIMESTAMP_NTZ in UTC (see ``schema``)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the tracker sends and what the raw store holds; Spark's own cast reads both.
_PLAIN = (
    r"^(?!0000)\d{4}-\d{2}-\d{2}[T ]([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d+)?"
    r"(Z|[+-]([01]\d|2[0-3]):?[0-5]\d)?$"
)
# Remaining ISO-8601 calendar forms: date only, basic form, short times, any one-character separator.
_ISO = (
    r"^(?!0000)(\d{4})(?:-(\d{2})-(\d{2})|(\d{2})(\d{2}))"
    r"(?:[\s\S]([01]\d|2[0-3])(?::?([0-5]\d)(?::?([0-5]\d)(?:[.,](\d+))?)?)?"
    r"(Z|[+-]([01]\d|2[0-3])(?::?[0-5]\d)?)?)?$"
)


def utc_wall_clock(ts: Column) -> Column:
    """TIMESTAMP (an instant) -> TIMESTAMP_NTZ in UTC, whatever the session time zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), epoch)


def wall_clock(at: datetime) -> Column:
    """Literal of a Python time; one with a zone is moved to UTC. A plain ``lit`` would pass through
    the zones of the driver process and of the session."""
    if at.tzinfo is not None:
        at = at.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def epoch_micros(at: Column) -> Column:
    """Microseconds of a UTC wall-clock time since 1970, without the session time zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, at)


def _with_zone(text: Column) -> Column:
    """Append ``Z`` to a plain time without an offset: such times count as UTC."""
    return F.regexp_replace(text, r"^(.{10}[^Z+-]*)$", "$1Z")


def _canonical(text: Column) -> Column:
    """Any ISO form -> the plain form: pull the parts into place, then fill the empty places."""
    text = F.regexp_replace(text, _ISO, "$1-$2$4-$3$5T$6:$7:$8.$9|$10")
    text = F.regexp_replace(text, r"T(?=:)", "T00")
    text = F.regexp_replace(text, r":(?=[:.])", ":00")
    text = F.regexp_replace(text, r"\.(\d{0,6})\d*\|", ".$1")
    text = F.regexp_replace(text, r"\.(?!\d)", "")
    text = F.regexp_replace(text, r"([+-]\d{2})$", "$1:00")
    return _with_zone(text)


def parse_ts(text: Column) -> Column:
    """ISO-8601 text -> UTC time; null when the text is no such time.

    ``+0000`` and ``+05:30`` offsets are applied, text without an offset counts as UTC. ``text``
    should be a plain column, as it is looked at several times.
    """
    instant = F.when(text.rlike(_PLAIN), _with_zone(text)).when(text.rlike(_ISO), _canonical(text))
    return utc_wall_clock(instant.try_cast("timestamp"))


def _written(ts: Column, separator: str) -> Column:
    text = ts.cast("string")
    fraction = F.substring(text, 20, 7)
    return F.concat(
        F.replace(F.substring(text, 1, 19), F.lit(" "), F.lit(separator)),
        F.when(fraction == "", "").otherwise(F.rpad(fraction, 7, "0")),
        F.lit("+00:00"))


def iso_format(ts: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS[.ffffff]+00:00``; the fraction only when it is not zero."""
    return _written(ts, "T")


def stored_format(ts: Column) -> Column:
    """Like ``iso_format`` with a space, the form of the raw store."""
    return _written(ts, " ")
