"""Operator 3, packing into optimal length buckets.

The global histogram of token counts is exact at every length.  Its entries are
the distinct lengths, and m of them need at least m * m / 2 tokens, so it has at
most sqrt(2 * tokens) rows: 100 000 in 5e9 tokens, 6 million in 2e13.  A dynamic
program over it chooses the ``buckets`` upper bounds with the least padding when
every document is padded to the bound of its bucket.  Bounds are lengths that
occur.  The best previous bound never moves down as the bound grows, so a layer
of the program is found by halving in about m * log2(m) steps.

Batches form inside buckets: a batch of bucket length L takes
``max(1, budget // L)`` documents, so its padded tokens stay within the budget
unless a single document is longer.  A bucket is cut by a hash of the id into
cells of about ``CELL`` documents, and positions are counted inside a cell, so
a bucket with most of the table is many tasks; each cell ends in at most one
batch that is not full.  Only (id, tokens) rows are shuffled.

Defined results: a null text has no token; documents without tokens are packed
in the first bucket; equal ids are packed separately, in any order; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanpress.llm.common import materialize

BUCKETS, BUDGET, CELL = 16, 65_536, 1 << 15


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))


def length_histogram(lengths: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The distinct lengths, ascending, and the documents of each."""
    rows = lengths.groupBy("n").agg(F.count(F.lit(1)).alias("docs")).toArrow()
    n, docs = (rows.column(k).to_numpy() for k in ("n", "docs"))
    order = n.argsort()
    return n[order], docs[order]


def _layer(cost: np.ndarray, tops: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least cost of the first j lengths with one bucket more, and the smallest i it starts from, for every j."""
    m = len(tops)
    now, back = cost.copy(), np.zeros(m + 1, np.int32)
    known = np.array([0, m + 1], np.int64)
    low_of, high_of = np.array([0], np.int64), np.array([m - 1], np.int64)
    while True:
        lows, highs = known[:-1], known[1:]
        wide = highs - lows > 1
        if not wide.any():
            return now, back
        mid = (lows[wide] + highs[wide]) // 2
        first, last = low_of[wide], np.minimum(high_of[wide], mid - 1)
        size = last - first + 1
        start = np.cumsum(size) - size
        i = np.arange(size.sum()) - np.repeat(start - first, size)
        j = np.repeat(mid, size)
        total = cost[i] + tops[j - 1] * (docs[j] - docs[i])
        least = np.minimum.reduceat(total, start)
        hits = np.flatnonzero(total == np.repeat(least, size))
        best = i[hits[np.searchsorted(hits, start)]]
        now[mid], back[mid] = least, best
        known = np.sort(np.concatenate([known, mid]))
        at = known[1:-1]
        low_of = np.concatenate([[0], back[at]])
        high_of = np.concatenate([back[at], [m - 1]])


def optimal_bounds(tops: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding; ties take the smaller bounds.

    ``tops`` are the distinct lengths, ascending, ``counts`` the documents of each.  Whole numbers while all
    documents padded to the longest stay below 2**62 tokens, beyond that 64 significant bits.
    """
    m = len(tops)
    if not m:
        return []
    number = np.int64 if int(tops[-1]) * int(counts.sum()) < 1 << 62 else np.longdouble
    tops, docs = tops.astype(number), np.concatenate([[0], np.cumsum(counts)]).astype(number)
    # cost[j]: padded tokens of the first j lengths; a bucket i..j costs its top times its documents.
    cost = np.concatenate([[0], tops * docs[1:]]).astype(number)
    choice = [np.zeros(m + 1, np.int32)]
    for _ in range(min(buckets, m) - 1):
        cost, back = _layer(cost, tops, docs)
        choice.append(back)
    bounds, j = [], m
    for back in reversed(choice):
        if j == 0:
            break
        bounds.append(int(tops[j - 1]))
        j = int(back[j])
    return bounds[::-1]


def pack(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n_tokens: Column | None = None,
    buckets: int = BUCKETS,
    budget: int = BUDGET,
    cell: int = CELL,
) -> DataFrame:
    """One row per document: doc_id, n_tokens, bucket, bucket_tokens, batch_id, slot, padding.

    ``n_tokens`` is the length to pack by (default: words of the text).
    """
    length = word_count(F.col(text_col)) if n_tokens is None else n_tokens
    lengths = materialize(df.select(F.col(id_col).alias("id"), length.cast("long").alias("n")), "lengths")
    tops, counts = length_histogram(lengths)
    bounds = optimal_bounds(tops, counts, buckets)
    sizes = np.bincount(np.searchsorted(bounds, tops), weights=counts, minlength=1).astype(np.int64).tolist()
    table = F.array(
        *[
            F.struct(
                F.lit(k).alias("bucket"), F.lit(b).cast("long").alias("top"), F.lit(max(1, budget // max(b, 1))).cast("long").alias("fit"),
                F.lit(-(-sizes[k] // cell)).cast("long").alias("cells"),
            )
            for k, b in enumerate(bounds or [0])
        ]
    )
    mixed = F.xxhash64(F.lit(17), "id")
    own = F.get(F.filter(table, lambda b: b["top"] >= F.col("n")), F.lit(0))
    rows = lengths.withColumn("own", own).select("id", "n", "own.*")
    rows = rows.withColumn("cell", F.pmod(mixed, F.greatest("cells", F.lit(1))))
    place = F.row_number().over(Window.partitionBy("bucket", "cell").orderBy(mixed, "id", "n")) - 1
    rows = rows.withColumn("place", place)
    batch = F.concat_ws("-", "bucket", "cell", F.floor(F.col("place") / F.col("fit")).cast("long"))
    return rows.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_tokens"),
        "bucket",
        F.col("top").alias("bucket_tokens"),
        batch.alias("batch_id"),
        F.pmod("place", "fit").cast("long").alias("slot"),
        (F.col("top") - F.col("n")).alias("padding"),
    )


def batches(packed: DataFrame) -> DataFrame:
    """One row per batch: batch_id, bucket_tokens, doc_ids in slot order (at most the batch's bounded fill), padded_tokens."""
    rows = packed.groupBy("batch_id", "bucket_tokens").agg(F.sort_array(F.collect_list(F.struct("slot", "doc_id"))).alias("rows"))
    return rows.select(
        "batch_id",
        "bucket_tokens",
        F.transform("rows", lambda r: r["doc_id"]).alias("doc_ids"),
        (F.size("rows") * F.col("bucket_tokens")).cast("long").alias("padded_tokens"),
    )
