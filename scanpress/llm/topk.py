"""Operator 1, exact top-k search by a Voronoi kNN join.

Largest inner products are nearest neighbours once every data vector gets one
more component, ``sqrt(M - |x|^2)`` with M the largest squared norm, and every
query a zero there.  In that space:

1. the square root of the rows, 64 to 4096, is the number of data vectors that
   are pivots; every row is assigned to its nearest pivot (its Voronoi cell)
   with its distance, in one pass;
2. a summary per cell (the k + 1 ids nearest to the pivot, each with its
   smallest distance, and the cell's rows and widest distances) is at most
   ``pivots * (k + 2)`` entries;
3. each query bounds the distance of its k-th neighbour from the summary and
   from the pivots, which are rows themselves;
4. queries are grouped in blocks of at most ``BLOCK`` by neighbouring cells.
   By the triangle inequality a block needs of each cell only the rows whose
   distance to the pivot lies in one interval, and only those are sent to it
   (cells of more than ``SALT`` rows are joined to the intervals in parts),
   cut into slices of about ``SLICE`` rows, so no task holds more than a block
   and a slice, however large a cell is;
5. each (block, slice) is solved with exact integer products in float64
   (int64 where a score could pass 2**53), keeping scores not below the
   queries' bounds; the best k per query remain.

Defined results: vectors that are null or hold null or non-finite components,
and rows without an id, take no part; shorter vectors count as padded with
zeros; ties go to the smaller id; rows that repeat an id are candidates each,
but never of a query with that id; of queries repeating an id the smallest
vector is asked; fewer candidates than k give them all; empty tables give an
empty result; extra columns are ignored.  Scores must fit 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanpress.llm.common import materialize

FEWEST, MOST = 64, 4096  # pivots
BLOCK, SLICE, SALT = 2048, 8192, 1 << 20
RESULT = "query_id long, rank int, vec_id long, score long"


def quantised(df: DataFrame, id_col: str, vec_col: str, scale: int = 256) -> DataFrame:
    """(id, v): ``floor(scale * x)`` of every component, of the vectors that take part."""
    v = F.col(vec_col)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = df.filter(F.col(id_col).isNotNull() & v.isNotNull() & ~odd)
    return rows.select(F.col(id_col).cast("long").alias("id"), whole.alias("v"))


def _matrix(column, dim: int) -> np.ndarray:
    """Rows of a list<long> column, padded with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), dim), np.int64)
    out[np.arange(dim)[None, :] < lengths[:, None]] = values
    return out


def _squared(v: np.ndarray) -> np.ndarray:
    return (v.astype(np.float64) ** 2).sum(axis=1)


def _products(a: np.ndarray, b: np.ndarray, exact_double: bool) -> np.ndarray:
    """Exact integer inner products."""
    return a.astype(np.float64) @ b.astype(np.float64).T if exact_double else a @ b.T


class _Space:
    """Pivots and the lifted distances to them."""

    def __init__(self, ids: np.ndarray, pivots: np.ndarray, largest: float, dim: int, exact_double: bool) -> None:
        self.ids, self.pivots, self.largest, self.dim, self.exact_double = ids, pivots, largest, dim, exact_double
        self.lift = np.sqrt(np.maximum(largest - _squared(pivots), 0))

    def of_data(self, v: np.ndarray) -> np.ndarray:
        own = _squared(v)
        lift = np.sqrt(np.maximum(self.largest - own, 0))
        inner = v.astype(np.float64) @ self.pivots.astype(np.float64).T + lift[:, None] * self.lift[None, :]
        return np.sqrt(np.maximum(2 * self.largest - 2 * inner, 0))

    def of_queries(self, v: np.ndarray) -> np.ndarray:
        inner = v.astype(np.float64) @ self.pivots.astype(np.float64).T
        return np.sqrt(np.maximum(_squared(v)[:, None] + self.largest - 2 * inner, 0))


def _space(data: DataFrame, pivots: int | None) -> _Space | None:
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    widest = F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))
    facts = data.agg(F.max(square).alias("m"), F.max(F.size("v")).alias("dim"), F.max(widest).alias("w"), F.count(F.lit(1)).alias("n"))
    facts = facts.first()
    if not facts.n:
        return None
    dim = max(facts.dim, 1)
    pivots = pivots or min(max(isqrt(facts.n), FEWEST), MOST)
    rows = data.orderBy(F.xxhash64("id"), "id", "v").limit(pivots).collect()  # at most ``pivots`` rows
    seen: dict[tuple, int] = {}
    for row in rows:
        seen.setdefault(tuple(row.v) + (0,) * (dim - len(row.v)), row.id)
    ids = np.array(list(seen.values()), np.int64)
    return _Space(ids, np.array(list(seen), np.int64).reshape(-1, dim), facts.m, dim, dim * (facts.w or 0) ** 2 < 2**53)


def _cells(data: DataFrame, space: _Space) -> DataFrame:
    """(id, v, cell, dist) of every row, written once."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = space.of_data(_matrix(batch.column(1), space.dim))
            cell = far.argmin(axis=1) if len(far) else np.empty(0, np.int64)
            dist = far[np.arange(len(far)), cell]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell, pa.int32()), pa.array(dist, pa.float64())], names=["id", "v", "cell", "dist"]
            )

    return materialize(data.mapInArrow(assign, "id long, v array<long>, cell int, dist double"), "cells")


def _bounded_queries(queries: DataFrame, space: _Space, nearest: list[tuple[int, int, float]], k: int, margin: float) -> DataFrame:
    """(id, v, cell, least, theta): least score worth keeping, and the distance within which the k nearest lie."""
    near_cells, near_ids = (np.array([n[j] for n in nearest], np.int64) for j in (0, 1))
    near_dists = np.array([n[2] for n in nearest], np.float64)

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            v = _matrix(batch.column(1), space.dim)
            far, cells, leasts, thetas = space.of_queries(v), [], [], []
            scores = _products(v, space.pivots, space.exact_double)
            for q, qid in enumerate(ids):
                others = np.sort(scores[q][space.ids != qid])
                least = int(others[-k]) if len(others) >= k else None
                # The k nearest by the summary that do not bear the query's id: each entry is a row of its own.
                reach = (far[q, near_cells] + near_dists)[near_ids != qid]
                theta = np.partition(reach, k - 1)[k - 1] if len(reach) >= k else np.inf
                if least is not None:
                    own = float((v[q].astype(np.float64) ** 2).sum())
                    theta = min(theta, np.sqrt(max(own + space.largest - 2.0 * least, 0)))
                cells.append(int(far[q].argmin()))
                leasts.append(least)
                thetas.append(theta + margin)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(cells, pa.int32()),
                    pa.array(leasts, pa.int64()),
                    pa.array(thetas, pa.float64()),
                ],
                names=["id", "v", "cell", "least", "theta"],
            )

    schema = "id long, v array<long>, cell int, least long, theta double"
    return materialize(queries.mapInArrow(bound, schema), "queries")


def _intervals(space: _Space, cells: dict[int, tuple[float, float]]):
    """(block, cell, low, high): the distances to each pivot that a block's queries can use, of cells that hold any."""
    held = np.array(sorted(cells), np.int64)
    nearest, farthest = (np.array([cells[c][j] for c in sorted(cells)]) for j in (0, 1))

    def run(asked: pa.Table) -> pa.Table:
        low, high = np.full(len(held), np.inf), np.full(len(held), -np.inf)
        for batch in asked.to_batches(max_chunksize=1024):
            far = space.of_queries(_matrix(batch.column("v"), space.dim))[:, held]
            theta = batch.column("theta").to_numpy(zero_copy_only=False)[:, None]
            low, high = np.minimum(low, (far - theta).min(axis=0)), np.maximum(high, (far + theta).max(axis=0))
        use = (low <= farthest) & (high >= nearest)
        block = np.full(use.sum(), asked.column("block")[0].as_py(), np.int32)
        return pa.table({"block": block, "cell": held[use].astype(np.int32), "low": low[use], "high": high[use]})

    return run


def _blocks(space: _Space, counts: dict[int, int], block: int) -> dict[int, tuple[int, int]]:
    """cell -> (first block, blocks): neighbouring cells share a block until it is full, a large cell gets several."""
    out, at, filled = {}, 0, 0
    left = set(counts)
    here = min(left, default=None)
    while left:
        left.discard(here)
        n = counts[here]
        if n > block:
            at += bool(filled)
            out[here] = (at, -(-n // block))
            at, filled = at + out[here][1], 0
        else:
            if filled + n > block:
                at, filled = at + 1, 0
            out[here] = (at, 1)
            filled += n
        if left:
            rest = sorted(left)
            here = rest[int(_squared(space.pivots[rest] - space.pivots[here]).argmin())]
    return out


def _solve(k: int, dim: int, exact_double: bool):
    """Best k of a slice for every query of a block."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if left.num_rows and right.num_rows:
            qids, ids = (t.column("id").to_numpy() for t in (left, right))
            least = left.column("least").to_pylist()
            order = np.argsort(ids, kind="stable")
            ids, data = ids[order], _matrix(right.column("v"), dim)[order]
            queries = _matrix(left.column("v"), dim)
            for at in range(0, len(qids), 256):
                scores = _products(queries[at : at + 256], data, exact_double)
                for row, qid, bound in zip(scores, qids[at : at + 256].tolist(), least[at : at + 256], strict=True):
                    may = np.flatnonzero((ids != qid) & (row >= bound) if bound is not None else ids != qid)
                    if len(may) > k:
                        may = may[row[may] >= np.partition(row[may], len(may) - k)[len(may) - k]]
                    may = may[np.argsort(-row[may], kind="stable")][:k]
                    out += [(qid, int(ids[m]), int(row[m])) for m in may]
        return pa.table({c: pa.array([o[j] for o in out], pa.int64()) for j, c in enumerate(("query_id", "vec_id", "score"))})

    return run


def voronoi_topk(
    data: DataFrame, queries: DataFrame, k: int = 5, pivots: int | None = None, block: int = BLOCK, slice_rows: int = SLICE, salt_rows: int = SALT
) -> DataFrame:
    """query_id, rank, vec_id, score for ``data(id, v)`` and ``queries(id, v)`` of integer vectors."""
    spark = data.sparkSession
    space = _space(data, pivots)
    queries = queries.groupBy("id").agg(F.min("v").alias("v"))
    if space is None:
        return spark.createDataFrame([], RESULT)
    cells = _cells(data, space)
    by_dist = Window.partitionBy("cell").orderBy("dist", "id")
    small = cells.groupBy("cell", "id").agg(F.min("dist").alias("dist"))  # an id counts once, however many rows repeat it
    small = small.withColumn("r", F.row_number().over(by_dist)).filter(F.col("r") <= k + 1).collect()
    nearest = [(row.cell, row.id, row.dist) for row in small]  # at most pivots * (k + 1)
    margin = 1e-7 * np.sqrt(space.largest + 1)
    asked = _bounded_queries(queries, space, nearest, k, margin)
    counts = {r.cell: r["count"] for r in asked.groupBy("cell").count().collect()}  # one row per pivot
    if not counts:
        return spark.createDataFrame([], RESULT)
    blocks = spark.createDataFrame([(c, a, n) for c, (a, n) in _blocks(space, counts, block).items()], "cell int, at int, n int")
    asked = asked.join(F.broadcast(blocks), "cell").withColumn(
        "block", F.col("at") + F.pmod(F.xxhash64("id"), F.col("n")).cast("int")
    )
    asked = materialize(asked.select("id", "v", "least", "theta", "block"), "blocks")

    facts = cells.groupBy("cell").agg(F.min("dist").alias("near"), F.max("dist").alias("far"), F.count(F.lit(1)).alias("n")).collect()
    reach = {r.cell: (r.near, r.far) for r in facts}  # one row per pivot
    bounds = asked.groupBy("block").applyInArrow(_intervals(space, reach), "block int, cell int, low double, high double")
    # A cell of many rows meets its intervals in parts.
    sizes = {r.cell: -(-r.n // salt_rows) for r in facts}
    parts = F.get(F.lit([sizes.get(c, 1) for c in range(len(space.pivots))]), F.col("cell"))
    bounds = bounds.withColumn("part", F.explode(F.sequence(F.lit(0), parts.cast("int") - 1)))
    rows = cells.withColumn("part", F.pmod(F.xxhash64("id", "v"), parts).cast("int"))
    useful: Column = F.col("dist").between(F.col("low"), F.col("high"))
    sent = rows.join(bounds, ["cell", "part"]).filter(useful).select("block", "id", "v")
    sent = materialize(sent, "sent")
    slices = sent.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / F.lit(slice_rows)).cast("long").alias("slices"))
    sent = sent.join(slices, "block").withColumn("slice", F.pmod(F.xxhash64("id", "v"), F.col("slices")))
    every = asked.select("block", "id", "v", "least").join(slices, "block")
    every = every.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
    solved = (
        every.select("block", "slice", "id", "v", "least")
        .groupBy("block", "slice")
        .cogroup(sent.select("block", "slice", "id", "v").groupBy("block", "slice"))
        .applyInArrow(_solve(k, space.dim, space.exact_double), "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = solved.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
