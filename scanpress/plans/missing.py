"""Scans that still have no articles (SRC-2, SRC-3, SET-1, JN-1, ORD-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scanpress.operators.audit import missing_scans, natural_sort
from scanpress.sources.files import list_article_names, read_scans


def missing_scan_report(spark: SparkSession, scans_dir: str, articles_dir: str) -> DataFrame:
    """Scan files (listed flat) whose stem is not the scan key of any file below ``articles_dir``.

    Naturally sorted by path; only paths are read, never the image bytes.
    """
    scans = read_scans(spark, scans_dir, with_content=False).select("path", "stem")
    names = list_article_names(spark, articles_dir)
    return natural_sort(missing_scans(scans, names), "path").select("path", "stem")
