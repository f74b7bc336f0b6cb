"""Component and book id from a file path."""

from __future__ import annotations

import posixpath
from functools import reduce
from urllib.parse import urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

from prosestat.constants import COMPONENT_KEYWORDS
from prosestat.functions.text import strip


def plain_path(uri: Column | str) -> Column:
    """A file-source path column without its percent escapes."""
    uri = F.col(uri) if isinstance(uri, str) else uri
    # taken for every row of a file: only an escape is worth decoding
    return F.when(F.contains(uri, F.lit("%")), F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))).otherwise(uri)


def file_name(path: Column | str) -> Column:
    return F.substring_index(path, "/", -1)


def path_below(path: Column | str, folder: str) -> Column:
    """A plain path relative to ``folder`` (no pattern), null for one that is not below it."""
    inner = "/" + posixpath.normpath(urlsplit(folder).path).strip("/") + "/"
    local = F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    at = F.position(F.lit(inner), local)
    return F.when(at > 0, F.substr(local, at + len(inner)))


def path_component(path: Column | str) -> Column:
    """Component named by the path, ``unknown`` if none; the first family wins."""
    lowered = F.lower(path)
    found = [F.when(reduce(Column.__or__, [F.contains(lowered, F.lit(key)) for key in keys]), name)
             for name, keys in COMPONENT_KEYWORDS.items()]
    return F.coalesce(*found, F.lit("unknown"))


def path_book_id(path: Column | str) -> Column:
    """Last all-digit path segment, else the file name's first number, else ``unknown``."""
    segments = F.split(path, r"[/\\]")
    numeric = F.filter(segments, lambda s: F.rlike(s, F.lit(r"^[0-9]+\z")))
    in_name = F.nullif(F.regexp_extract(file_name(path), "([0-9]+)", 1), F.lit(""))
    return F.coalesce(F.try_element_at(numeric, F.lit(-1)), in_name, F.lit("unknown"))


def stem_book_id(path: Column | str) -> Column:
    """File name without its extension, white space as ``_``; ``unknown`` if empty."""
    stem = F.regexp_replace(file_name(path), r"(?s)^(\.*[^.].*)\.[^.]*\z", "$1")
    return F.coalesce(
        F.nullif(F.regexp_replace(strip(stem), r"(?U)[\s\x1C-\x1F]+", "_"), F.lit("")),
        F.lit("unknown"))
