"""Scans without articles, natural order, sampling, run counts (SET-1, JN-1, ORD-1, ORD-2, AG-4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanpress.functions.names import scan_key
from scanpress.functions.text import _c


def distinct_keys(names: DataFrame, name: str = "file_name") -> DataFrame:
    """SET-1: the set of scan keys of article names.

    ``distinct`` aggregates map-side first, so a key shared by a great many
    articles is one row per task before the shuffle.
    """
    return names.select(scan_key(name).alias("scan_key")).distinct()


def missing_scans(scans: DataFrame, names: DataFrame, stem: str = "stem", name: str = "file_name") -> DataFrame:
    """JN-1: scans whose stem is not the scan key of any article name (anti join)."""
    keys = distinct_keys(names, name)
    return scans.join(keys, scans[stem] == keys["scan_key"], "left_anti")


def natural_key(col: Column | str) -> Column:
    """ORD-1 sort key: digit runs compare as numbers (length, then digits) and before text, text runs as text."""
    runs = F.regexp_extract_all(_c(col), F.lit(r"([0-9]+|[^0-9]+)"), 1)

    def encode(run: Column) -> Column:
        digits = F.regexp_replace(run, "^0+", "")
        return F.when(
            run.rlike("^[0-9]"), F.concat(F.lit("\x01"), F.lpad(F.length(digits).cast("string"), 10, "0"), digits)
        ).otherwise(run)

    return F.array_join(F.transform(runs, encode), "")


def natural_sort(df: DataFrame, col: str) -> DataFrame:
    """ORD-1: global natural order (range-partitioned sort; keep it as the last step)."""
    return df.withColumn("natural_key", natural_key(col)).orderBy("natural_key", col)


def sample_key(key: Column | str, seed: int) -> Column:
    return F.md5(F.concat(_c(key).cast("string"), F.lit(str(seed))))


#: Buckets of the sample's histogram: leading hexadecimal digits of the hash.
SAMPLE_DIGITS = 3


def sample_n(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """ORD-2: n rows without replacement, the same n for the same seed; n = 0 means all.

    The n rows with the smallest hashes of the key (ties to the smaller key)
    are kept, in the partitions they are in.  Only keys are looked at: a
    histogram over the hash's leading digits (at most ``16 ** SAMPLE_DIGITS``
    counts) finds the bucket that holds the n-th hash; that bucket alone is
    ordered, to find its last row.  Then one filter keeps the rows up to it, so
    the other columns of a file or table are read once, for rows that stay.
    Rows that repeat the last key are cut to n by their order in their bucket.
    """
    if n <= 0:
        return df
    keyed = df.withColumn("sample_key", sample_key(key, seed))
    keys = keyed.select("sample_key", key).filter(F.col("sample_key").isNotNull())
    bucket = F.left("sample_key", F.lit(SAMPLE_DIGITS))
    counts = keys.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    left, last = n, None
    for row in sorted(counts, key=lambda r: r.b):
        if row.n >= left:
            last = row.b
            break
        left -= row.n
    if last is None:  # not more rows than asked for
        return keyed
    inside = keys.filter(bucket == last).groupBy("sample_key").agg(F.count(F.lit(1)).alias("n"))
    edge = inside.orderBy("sample_key").limit(left).collect()
    for row in edge:
        if row.n >= left:
            below = F.col("sample_key") < row.sample_key
            if row.n == left:
                return keyed.filter(below | (F.col("sample_key") == row.sample_key))
            return keyed.filter(below).unionByName(keyed.filter(F.col("sample_key") == row.sample_key).limit(left))
        left -= row.n
    return keyed


def run_summary(replies: DataFrame, page: str = "page_id") -> DataFrame:
    """AG-4: pages handled (failed ones too), replies, failures, articles, replies without usage.

    Articles are those of each page's first successful attempt, which a job writes.  ``page`` names the page: a scan's
    path where scans of several folders share names.  Two levels instead of ``count(DISTINCT page_id)`` beside other
    aggregates (which Spark plans with an ``Expand`` that doubles the rows):
    per-page partial sums, combined map-side, then one small total.
    """
    ok = F.col("status") == "OK"
    written = F.sum(F.when(ok, F.col("n_articles")))
    if "attempt" in replies.columns:
        written = F.expr("min_by(n_articles, attempt) FILTER (WHERE status = 'OK')")
    per_page = replies.groupBy(page).agg(
        F.count(F.lit(1)).alias("replies"),
        F.count_if(ok).alias("ok_replies"),
        F.count_if(~ok).alias("failed_replies"),
        written.alias("articles"),
        F.count_if(F.col("input_tokens").isNull() | F.col("output_tokens").isNull()).alias(
            "replies_without_usage"
        ),
    )
    return per_page.agg(
        F.count(F.lit(1)).alias("pages_done"),
        F.coalesce(F.sum("replies"), F.lit(0)).cast("long").alias("replies"),
        F.coalesce(F.sum("ok_replies"), F.lit(0)).cast("long").alias("ok_replies"),
        F.coalesce(F.sum("failed_replies"), F.lit(0)).cast("long").alias("failed_replies"),
        F.coalesce(F.sum("articles"), F.lit(0)).cast("long").alias("articles"),
        F.coalesce(F.sum("replies_without_usage"), F.lit(0)).cast("long").alias("replies_without_usage"),
    )


def failure_reasons(replies: DataFrame) -> DataFrame:
    """AG-4: failed replies per reason."""
    return (
        replies.filter(F.col("status") != "OK")
        .groupBy(F.col("status").alias("reason"))
        .agg(F.count(F.lit(1)).alias("replies"))
    )
