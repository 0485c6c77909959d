"""Row numbers and running sums within groups that stay parallel when one group is huge.

``row_number() OVER (PARTITION BY keys ORDER BY order)`` puts every row of a
group in one task; a group holding a third of the table would run on one
core.  Here groups of more than ``HOT_ROWS`` rows are *hot*:

* all other rows take the plain window - one shuffle;
* hot rows are range-partitioned on ``(keys, order)``, so the sampled range
  bounds cut a hot group into many partitions, each holding a contiguous
  slice of it:

  1. local running sums per ``(keys, partition)`` - the window's exchange
     hashes on the partition id too, so the hot group is spread out;
  2. only the first and the last group of a partition can continue into the
     next one, so the offsets (sums of the same group in earlier partitions)
     come from at most ``2 x partitions`` boundary entries; the partitions are
     at most ``MOST_PARTITIONS``, so that table is broadcast;
  3. result = local sum + offset.

The keys of hot groups stay a table (one row per ``HOT_ROWS`` rows at most),
and AQE decides how it is joined.

Rows with equal ``(keys, order)`` always share a partition, so the result
is the same as the plain window for any data.  The range-partitioned rows
are written once with their partition id as a column (a table in the shared
checkpoint folder): the row branch and the offset branch see one assignment
(re-sampling seeds from RDD ids and could cut differently), a lost executor
cannot change it, and the offset branch reads only the key columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 2_000_000
MOST_PARTITIONS = 4000


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Write the frame as a table in the shared checkpoint folder and read it back.

    This cuts the lineage (a lost executor re-reads the table instead of
    recomputing upstream work), and unlike an RDD checkpoint the table is
    columnar: later branches read only the columns they use.
    """
    from scanpress.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def plain_running_sum(df: DataFrame, keys: list[str], order: list[str], value: Column, out: str) -> DataFrame:
    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(value).over(upto).cast("long"))


def _split_running_sum(df: DataFrame, keys: list[str], order: list[str], value: Column, out: str, n: int) -> DataFrame:
    """Range-split form: any group, however large, is cut over ``n`` partitions."""
    # Range bounds come from sampling seeded by RDD ids, so two evaluations of
    # the same exchange may cut differently; the partition assignment is
    # written once and every branch below reads that same copy.
    ranged = materialize(
        df.withColumn("_v", value)
        .repartitionByRange(n, *keys, *order)
        .withColumn("_pid", F.spark_partition_id()),
        "ranged",
    )
    upto = Window.partitionBy(*keys, "_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumn("_local", F.sum("_v").over(upto))

    group = F.struct(*[F.col(k) for k in keys])
    edges = ranged.groupBy("_pid").agg(F.min(group).alias("_first"), F.max(group).alias("_last"))
    at_edge = ranged.join(F.broadcast(edges), "_pid").filter(
        group.eqNullSafe(F.col("_first")) | group.eqNullSafe(F.col("_last"))
    )
    sums = at_edge.groupBy(*keys, "_pid").agg(F.sum("_v").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, "_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))

    o = F.broadcast(offsets.select(*[F.col(k).alias(f"_o_{k}") for k in keys], F.col("_pid").alias("_o_pid"), "_offset"))
    cond = reduce(
        lambda a, b: a & b,
        [local[k].eqNullSafe(o[f"_o_{k}"]) for k in keys] + [local["_pid"] == o["_o_pid"]],
    )
    joined = local.join(o, cond, "left")
    total = (F.col("_local") + F.coalesce(F.col("_offset"), F.lit(0))).cast("long")
    return joined.withColumn(out, total).drop("_v", "_pid", "_local", "_offset", "_o_pid", *[f"_o_{k}" for k in keys])


def running_sum_within(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column,
    out: str,
    partitions: int | None = None,
    materialized: bool = True,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Exact running sum of ``value`` within ``keys`` in ``order`` (rows up to the current one), skew-safe.

    Groups of more than ``hot_rows`` rows take the range-split form (in
    ``partitions`` tasks, by default one per half of ``hot_rows``, at most
    ``MOST_PARTITIONS``), all other rows the single window (one shuffle).  The
    input is written first (``materialized=True``) because it is read more
    than once; the group counts then read only the key columns.
    """
    if materialized:
        df = materialize(df)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > hot_rows)
    sizes = materialize(sizes, "hot-groups")
    rows = sizes.agg(F.sum("_rows")).first()[0]
    if not rows:
        return plain_running_sum(df, keys, order, value, out)
    n = partitions or min(2 * -(-rows // hot_rows), MOST_PARTITIONS)
    hot = sizes.select(*[F.col(k).alias(f"_h_{k}") for k in keys])
    cond = reduce(lambda a, b: a & b, [df[k].eqNullSafe(hot[f"_h_{k}"]) for k in keys])
    normal = plain_running_sum(df.join(hot, cond, "left_anti"), keys, order, value, out)
    large = _split_running_sum(df.join(hot, cond, "left_semi"), keys, order, value, out, n)
    return normal.unionByName(large)


def rank_within(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    out: str = "rank",
    partitions: int | None = None,
    materialized: bool = True,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Exact 1-based row number within ``keys`` ordered by ``order``, skew-safe.

    ``order`` must make rows of a group distinct (as a row number needs).
    """
    return running_sum_within(df, keys, order, F.lit(1), out, partitions, materialized, hot_rows)
