"""Operator 10, exact dedup by a heavy-hitter split.

Texts are equal when identical after deleting every character of
``[\\x20\\x09-\\x0D]``.  Of equal texts the row with the most code points in
the original text stays, then the smallest id.

Method:

1. each row becomes (id, code points, SHA-256), written once - texts are
   never shuffled;
2. every partition keeps a Misra-Gries summary of ``counters`` digests; the
   summaries are added up.  A summary undercounts by at most
   ``rows / (counters + 1)``, so every digest held by ``2 / (counters + 1)``
   of the rows or more has a summed estimate of at least
   ``rows / (counters + 1)``, and as estimates never exceed the rows, at most
   ``counters + 1`` digests reach it: the bound of everything broadcast here;
3. the candidates' exact counts and winners are aggregated (map-side
   combine), and broadcast back: their rows are decided without a shuffle;
4. all other digests take an ordinary shuffle on the digest.

Defined results: a null text counts as empty; all empty or blank texts are
equal; a null id sorts before every other; of rows that agree in id and
length one (any) stays.  An empty table gives an empty result.  Extra columns
are ignored by :func:`exact_dedup` and carried by :func:`drop_duplicates`.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanpress.llm.common import broadcast_ids, materialize

COUNTERS = 1023


def text_digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of the text without white space."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", ""), 256)


def misra_gries(batches: Iterator[pa.RecordBatch], counters: int) -> dict[str, int]:
    """Mergeable Misra-Gries summary of the first column: at most ``counters`` values, undercounted."""
    held: dict[str, int] = {}
    for batch in batches:
        counted = batch.column(0).value_counts()
        for value, n in zip(counted.field(0).to_pylist(), counted.field(1).to_pylist(), strict=True):
            held[value] = held.get(value, 0) + n
        if len(held) > counters:
            cut = heapq.nlargest(counters + 1, held.values())[-1]
            held = {value: n - cut for value, n in held.items() if n > cut}
    return held


def _heavy(rows: DataFrame, counters: int) -> DataFrame:
    """Digests whose summed Misra-Gries estimate reaches ``rows / (counters + 1)``: at most ``counters + 1``."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = misra_gries(batches, counters)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["digest", "n"]
        )

    total = rows.count()
    summed = rows.select("digest").mapInArrow(summarise, "digest string, n long").groupBy("digest").agg(F.sum("n").alias("n"))
    return summed.filter((F.col("n") > 1) & (F.col("n") * (counters + 1) >= total)).select("digest")


def _decided(df: DataFrame, id_col: str, text_col: str, counters: int) -> tuple[DataFrame, DataFrame]:
    """(rows with the winner and size of their group, the heavy digests' winners)."""
    rows = materialize(
        df.select(
            F.col(id_col).alias("id"),
            F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("chars"),
            text_digest(F.col(text_col)).alias("digest"),
        ).withColumn("rid", F.monotonically_increasing_id()),
        "digests",
    )
    best = F.min(F.struct((-F.col("chars")).alias("less"), "id", "rid"))
    heavy = _heavy(rows, counters)
    winners = materialize(
        rows.join(F.broadcast(heavy), "digest").groupBy("digest").agg(best.alias("best"), F.count(F.lit(1)).alias("size")),
        "winners",
    )
    hot = rows.join(F.broadcast(winners), "digest")
    same = Window.partitionBy("digest")
    rest = (
        rows.join(F.broadcast(winners), "digest", "left_anti")
        .withColumn("best", best.over(same))
        .withColumn("size", F.count(F.lit(1)).over(same))
    )
    return hot.unionByName(rest), winners


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    decided, _ = _decided(df, id_col, text_col, counters)
    return decided.select(
        F.col("id").alias("doc_id"),
        F.col("best.id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("rid") == F.col("best.rid")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The rows that stay, with all their columns.

    Copies of heavy digests are removed map-side against the broadcast
    winners; the other copies by an anti join on the id, against a broadcast
    while they are few, so that texts are not shuffled.  Where ids repeat, rows
    are matched on (id, length, digest) instead.
    """
    decided, winners = _decided(df, id_col, text_col, counters)
    columns = df.columns
    digest, chars = "__dedup_digest", "__dedup_chars"
    with_digest = df.withColumn(digest, text_digest(F.col(text_col)))
    repeated = decided.groupBy("id").count().filter((F.col("count") > 1) | F.col("id").isNull())
    if repeated.limit(1).count():
        stay = decided.filter(F.col("rid") == F.col("best.rid")).select(
            F.col("id").alias("__dedup_id"), F.col("digest").alias("__dedup_to"), F.col("chars").alias("__dedup_n")
        )
        rows = with_digest.withColumn(chars, F.length(F.coalesce(F.col(text_col), F.lit(""))))
        on = (
            rows[id_col].eqNullSafe(stay["__dedup_id"])
            & (rows[digest] == stay["__dedup_to"])
            & (rows[chars] == stay["__dedup_n"])
        )
        return rows.join(stay, on, "left_semi").dropDuplicates([digest]).select(*columns)
    lost = decided.filter(F.col("rid") != F.col("best.rid"))
    if winners.limit(1).count():
        best = winners.select(F.col("digest").alias(digest), F.col("best.id").alias("__dedup_id"))
        df = (
            with_digest.join(F.broadcast(best), digest, "left")
            .filter(F.col("__dedup_id").isNull() | (F.col("__dedup_id") == F.col(id_col)))
            .select(*columns)
        )
        lost = lost.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    gone = broadcast_ids(materialize(lost.select(F.col("id").alias("__dedup_id")), "gone"))
    return df.join(gone, df[id_col] == gone["__dedup_id"], "left_anti").select(*columns)
