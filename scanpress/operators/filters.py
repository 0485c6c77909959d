"""Filters and side tables (FLT-1, FLT-2, FLT-3, FLT-4).

Nothing aborts a job: rows that fail a check are kept in a side table with
the reason, and the job goes on with the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanpress.functions.containers import image_damage
from scanpress.functions.images import image_kind
from scanpress.functions.names import article_issue, article_name_ok, article_page
from scanpress.functions.replies import is_accepted
from scanpress.operators.extract import with_reply_status


def accepted(replies: DataFrame) -> DataFrame:
    """FLT-1: replies whose finish reason is accepted (``STOP``, ``end_turn``, ``stop``)."""
    if "finish_reason" not in replies.columns:
        replies = with_reply_status(replies)
    return replies.filter(is_accepted("finish_reason"))


def quarantine(replies: DataFrame) -> DataFrame:
    """FLT-2: failed replies with their reason; the others go on to extraction."""
    if "status" not in replies.columns:
        replies = with_reply_status(replies)
    return replies.filter(F.col("status") != "OK").select(
        "page_id", "model", "attempt", "finish_reason", F.col("status").alias("reason")
    )


def valid_scans(scans: DataFrame, content: str = "content") -> DataFrame:
    """FLT-3: image format from the magic bytes, and whether the container is whole up to its end marker.

    ``damage`` says why not.  The walk runs in the tasks that hold the bytes, which never enter a shuffle.
    """
    checked = scans.withColumn("image_kind", image_kind(content))
    checked = checked.withColumn("damage", image_damage(content, F.col("image_kind")))
    return checked.withColumn("valid", F.col("damage").isNull())


def bad_names(files: DataFrame, name: str = "file_name") -> DataFrame:
    """FLT-4: article names that break ``<pub>_<issue>-<page>_<slug>.html``."""
    return files.filter(~article_name_ok(name))


def parse_article_names(files: DataFrame, name: str = "file_name") -> DataFrame:
    """SC-2 over a table: issue and page of the names that follow the contract."""
    return files.filter(article_name_ok(name)).select(
        "*", article_issue(name).alias("issue"), article_page(name).alias("page")
    )
