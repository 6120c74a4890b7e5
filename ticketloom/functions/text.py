"""Text expressions. All are built-in Spark expressions: no Python runs per row."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import lru_cache
from html import unescape
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketloom.schema import RESOLUTION_KEYWORDS

TAG = r"<[^>]+>"

# White space other than the plain space. Java's \s is ASCII only, and (?U)\s leaves out the four
# separators \x1c-\x1f. The first class lets ASCII text fail after one range test.
_ODD_SPACE = r"[[^ -~]&&[\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\p{Z}]]"

# Entities that cover nearly all text; they are tried before the complete table.
COMMON_ENTITIES = ["amp;", "lt;", "gt;", "quot;", "nbsp;", "#39;", "copy;", "middot;"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also inside lambda bodies and ``when``."""
    return F.get(F.transform(F.array(value), body), 0)


def _entity_names() -> str:
    """HTML5 names of the stdlib as JSON: {first character: {name: text}}."""
    groups: dict[str, dict[str, str]] = {}
    for name, text in html5.items():
        groups.setdefault(name[0], {})[name] = text
    return json.dumps(groups).replace("'", "\\u0027")


def _names_without_semicolon() -> str:
    """Names that HTML5 also decodes without a semicolon, longest first."""
    return "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))


def _windows_1252() -> str:
    """Characters of the numbers 128 to 159, which HTML5 reads as Windows-1252 bytes where it can."""
    def char(n: int) -> str:
        try:
            return bytes([n]).decode("cp1252")
        except UnicodeDecodeError:
            return chr(n)
    return "".join(f"\\u{ord(char(n)):04x}" for n in range(128, 160))


def _common_cases() -> str:
    return "\n".join(
        f"WHEN startswith(p, '{name}') THEN concat('\\u{ord(unescape('&' + name)):04x}', substr(p, {len(name) + 1}))"
        for name in COMMON_ENTITIES)


@lru_cache(maxsize=1)
def _clean_text_sql() -> str:
    """``clean_text`` as a SQL lambda: one parse instead of a thousand calls to build the tree.

    ``transform(array(x), v -> ...)[0]`` binds ``v``, so that each step is computed once. A reference
    never spans two ``&``: the text is cut there, and ``p`` is what follows one of them.
    """
    strip = f"CASE WHEN contains(t, '<') THEN regexp_replace(t, r'{TAG}', '') ELSE t END"
    number = r"""
        CASE WHEN p RLIKE r'^#[0-9]' THEN transform(array(regexp_extract(p, r'^#0*([0-9]*)', 1)),
               d -> CASE WHEN d = '' THEN 0 WHEN length(d) <= 7 THEN int(d) END)[0]
             ELSE transform(array(regexp_extract(p, r'^#[xX]0*([0-9a-fA-F]*)', 1)),
               d -> CASE WHEN d = '' THEN 0 WHEN length(d) <= 6 THEN int(conv(d, 16, 10)) END)[0] END"""
    # null: more digits than the largest code point has. Noncharacters and most controls vanish.
    character = f"""
        CASE WHEN c IS NULL OR c = 0 OR c > 1114111 OR c BETWEEN 55296 AND 57343 THEN '\\uFFFD'
             WHEN c = 13 THEN '\\u000d'
             WHEN c BETWEEN 128 AND 159 THEN substr('{_windows_1252()}', c - 127, 1)
             WHEN c BETWEEN 1 AND 8 OR c = 11 OR c BETWEEN 14 AND 31 OR c = 127
               OR c BETWEEN 64976 AND 65007 OR c % 65536 >= 65534 THEN ''
             ELSE decode(unhex(lpad(hex(c), 8, '0')), 'UTF-32') END"""
    full = r"regexp_extract(p, r'^[^\t\n\f <&#;]{1,32};', 0)"
    bare = f"regexp_extract(p, '^(?:{_names_without_semicolon()})', 0)"
    # from_json of a constant is folded into one map value when the query is planned
    piece = f"""
        CASE WHEN p = '' THEN '&'
             {_common_cases()}
             WHEN p RLIKE r'^#([0-9]|[xX][0-9a-fA-F])' THEN concat(
               transform(array({number}), c -> {character})[0],
               regexp_extract(p, r'(?s)^#(?:[0-9]+|[xX][0-9a-fA-F]+);?(.*)', 1))
             ELSE transform(
               array(element_at(from_json(r'{_entity_names()}', 'map<string,map<string,string>>'), left(p, 1))),
               g -> coalesce(
                 concat(element_at(g, {full}), substr(p, length({full}) + 1)),
                 concat(element_at(g, {bare}), substr(p, length({bare}) + 1)),
                 concat('&', p)))[0] END"""
    decode = f"""
        CASE WHEN contains(s, '&') THEN transform(array(split(s, '&', -1)), pieces ->
               concat(pieces[0], array_join(transform(slice(pieces, 2, size(pieces)), p -> {piece}), '')))[0]
             ELSE s END"""
    # most spaces stand alone, and no regular expression has to match those
    collapse = f"""
        transform(array(regexp_replace(d, r'{_ODD_SPACE}', ' ')),
          w -> trim(CASE WHEN contains(w, '  ') THEN regexp_replace(w, ' {{2,}}', ' ') ELSE w END))[0]"""
    return f"""t -> coalesce(transform(array({strip}), s -> transform(array({decode}), d -> {collapse})[0])[0], '')"""


def clean_texts(texts: Column) -> Column:
    """``clean_text`` of each element of an array."""
    return F.call_function("transform", texts, F.expr(_clean_text_sql()))


def clean_text(text: Column) -> Column:
    """HTML tags out, HTML5 references decoded (named and numeric, in one pass), white space
    collapsed and trimmed; null gives ''. The order matters: an escaped tag is text, so it survives.
    """
    return F.get(clean_texts(F.array(text)), 0)


def truncate(text: Column, n: int) -> Column:
    """First ``n`` code points."""
    return F.substring(text, 1, n)


def strip_ends(text: Column) -> Column:
    """Trim spaces and line feeds, the only white space that assembled text can begin or end with."""
    return F.btrim(text, F.lit(" \n"))


def nonblank(text: Column) -> Column:
    """'' -> null, which ``concat_ws`` leaves out."""
    return F.nullif(text, F.lit(""))


def labelled(label: str, text: Column) -> Column:
    """``label: text``, or null for blank text."""
    return F.concat(F.lit(f"{label}: "), nonblank(text))


def join_nonblank(sep: str, *parts: Column) -> Column:
    """Join the parts that are neither null nor ''."""
    return F.concat_ws(sep, *[nonblank(p) for p in parts])


def contains_resolution_keywords(body: Column, keywords: list[str] | None = None) -> Column:
    """Case-insensitive substring test ("pr" is in "problem"), on the raw body."""
    def any_of(lowered: Column) -> Column:
        found = F.lit(False)
        for keyword in keywords or RESOLUTION_KEYWORDS:
            found = found | F.contains(lowered, F.lit(keyword))
        return found

    return F.coalesce(let(F.lower(body), any_of), F.lit(False))
