"""Project names taken from keys, URLs and file paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def name_of(doc: Column, path: str, attribute: str = "name") -> Column:
    """``name`` (or another text attribute) of the object at ``path`` of a VARIANT; '' without one."""
    return F.coalesce(F.try_variant_get(doc, f"{path}.{attribute}", "string"), F.lit(""))


def project_from_key(key: Column) -> Column:
    """Text before the first ``-``; null without one."""
    return F.when(key.contains("-"), F.substring_index(key, "-", 1))


def project_from_url(url: Column) -> Column:
    """First part of the URL that starts with a letter and holds ``-``, cut at that ``-``."""
    part = F.filter(F.split(url, "/", -1), lambda p: p.contains("-") & p.rlike(r"^\p{L}"))
    return F.substring_index(F.get(part, 0), "-", 1)


def path_text(path: Column) -> Column:
    """Undo the URI escaping of ``_metadata.file_path``."""
    escaped = F.replace(path, F.lit("+"), F.lit("%2B"))
    return F.coalesce(F.try_url_decode(escaped), path)


def project_from_path(path: Column, root: str) -> Column:
    """Project named by the path of a file; null when the path tells nothing.

    The parent directory (``P`` or ``project=P``) names it. A file directly in the root (old layout)
    is named by its stem up to the first ``-``.
    """
    parts = F.split(path, "/", -1)
    parent = F.regexp_replace(F.coalesce(F.try_element_at(parts, F.lit(-2)), F.lit("")), "^project=", "")
    stem = F.regexp_replace(F.element_at(parts, -1), r"(?<!^)\.[^.]*$", "")
    root_name = root.rstrip("/").rsplit("/", 1)[-1]
    return F.when(parent.isin("", "raw", root_name), project_from_key(stem)).otherwise(parent)


def project_from_object_key(path: Column) -> Column:
    """Second component of an object-store key; null where that is the file itself or there is none."""
    key = F.regexp_replace(path, r"^[A-Za-z0-9+.-]+://[^/]*/", "")
    parts = F.split(key, "/", -1)
    return F.when(F.size(parts) > 2, F.get(parts, 1))
