"""Primary and fallback attempts (SET-2, AG-3)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_attempts(*attempts: DataFrame) -> DataFrame:
    """SET-2: the attempts of every model in one table (by column name)."""
    return reduce(lambda a, b: a.unionByName(b), attempts)


def first_success(attempts: DataFrame, page: str = "page_id") -> DataFrame:
    """AG-3: per page, the first attempt (in model order) that succeeded.

    A page where every attempt failed keeps the reason of attempt 0, as a
    fallback chain reports its primary error.  Groups are pages, bounded by
    the number of models.
    """
    agg = attempts.groupBy(page).agg(
        F.count(F.lit(1)).alias("attempts"),
        F.expr("min(attempt) FILTER (WHERE ok)").alias("chosen_attempt"),
        F.expr("min_by(model, attempt) FILTER (WHERE ok)").alias("chosen_model"),
        F.min_by("status", "attempt").alias("first_status"),
    )
    return agg.select(
        page,
        "attempts",
        "chosen_attempt",
        "chosen_model",
        F.when(F.col("chosen_attempt").isNotNull(), F.lit("OK")).otherwise(F.col("first_status")).alias("status"),
    )


def first_successful_replies(replies: DataFrame, page: str = "page_id") -> DataFrame:
    """Keep, per page, only the reply of the first attempt whose status is ``OK``.

    A fallback chain stops at its first success, so only that attempt's
    articles exist.  The choice is an aggregate with map-side combine, then
    a semi join (AQE can split a skewed page).
    """
    chosen = replies.filter(F.col("status") == "OK").groupBy(page).agg(F.min("attempt").alias("attempt"))
    return replies.join(chosen, [page, "attempt"], "left_semi")
