"""File-name functions: scan names, article names, scan keys (SC-1, SC-2, SC-3, FLT-4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scanpress.functions.text import _c

SCAN_STEM = r"^(.*)-([0-9]+)$"
# <first>_<issue>-<page>_<rest>: a stem with at least two "_" whose middle
# token holds exactly one "-" and a numeric page.
ARTICLE_STEM = r"^[^_]*_([^_-]*)-([0-9]+)_"


def file_stem(col: Column | str) -> Column:
    """``Path(name).stem``: the name without its last suffix."""
    return F.regexp_extract(_c(col), r"^(.+?)(\.[^.]*)?$", 1)


def base_name(col: Column | str) -> Column:
    """Last path component of a path or URI."""
    return F.regexp_extract(_c(col), r"([^/]*)$", 1)


def scan_issue(stem: Column | str) -> Column:
    """SC-1: issue of a scan stem, split at the last ``-``."""
    s = _c(stem)
    return F.when(s.rlike(SCAN_STEM), F.regexp_extract(s, SCAN_STEM, 1))


def scan_page(stem: Column | str) -> Column:
    """SC-1: page of a scan stem as written (no +1)."""
    s = _c(stem)
    return F.when(s.rlike(SCAN_STEM), F.regexp_extract(s, SCAN_STEM, 2)).try_cast("int")


def article_name_ok(file_name: Column | str) -> Column:
    """FLT-4: the article name follows ``<pub>_<issue>-<page>_<slug>.<ext>``."""
    return file_stem(file_name).rlike(ARTICLE_STEM)


def article_issue(file_name: Column | str) -> Column:
    """SC-2: issue of an article file name (the first ``_`` token is dropped)."""
    stem = file_stem(file_name)
    return F.when(stem.rlike(ARTICLE_STEM), F.regexp_extract(stem, ARTICLE_STEM, 1))


def article_page(file_name: Column | str) -> Column:
    """SC-2: page of an article file name, counted from 1 (written page + 1)."""
    stem = file_stem(file_name)
    raw = F.when(stem.rlike(ARTICLE_STEM), F.regexp_extract(stem, ARTICLE_STEM, 2))
    return (raw.try_cast("long") + F.lit(1)).try_cast("int")


def scan_key(file_name: Column | str) -> Column:
    """SC-3: first two ``_`` tokens of a name (the whole name when it has one ``_``)."""
    return F.substring_index(_c(file_name), "_", 2)
