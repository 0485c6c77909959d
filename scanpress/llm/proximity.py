"""Operator 13, approximate nearest neighbours by a robust-pruned directed graph.

Nearness is the largest inner product.  A component ``sqrt(M - |x|^2)``, M the
largest squared norm of a shard, puts a shard's vectors on one sphere, where
the nearest to a query (zero there) have the largest products.

Index, one row per distinct vector:

1. copies of a vector are one node with its smallest ``copies`` ids: a search
   for k never returns more than k + 1 of them, so nothing is lost, however
   many rows hold the same vector (counts are cut before the shuffle);
2. nodes are dealt to shards of about ``SHARD`` by a hash of the vector;
3. a task builds its shard's graph.  Nodes are inserted in batches: a greedy
   beam search over the graph so far proposes neighbours, and relaxed pruning
   keeps diverse edges: of the nearest proposals p, every one q with
   ``alpha * d(p, q) <= d(node, q)`` goes.  Edges are also entered backwards,
   and a node with more than ``DEGREE`` of them is pruned again.  A second
   pass proposes anew for every node over the whole graph;
4. nodes and edges are a table, read again by any number of searches.

Search: every query meets every shard, in blocks of about ``BLOCK`` queries, so
a task holds a shard and a block.  A beam search from the entry nodes keeps the
``beam`` best nodes; the found are scored again in double precision on the
original vectors, ids in place of nodes, and the best k of all shards remain.

Defined results: vectors that are null, zero (or empty) or hold null or
non-finite components, and rows without an id, take no part; shorter vectors
count as padded with zeros; rows that repeat id and vector count once, an id
with several vectors is a candidate with each, and asks with the smallest;
ties go to the smaller id; fewer candidates than k give all found; empty tables
give an empty result; extra columns are ignored.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scanpress.llm.common import materialize

SHARD, BLOCK, DEGREE, BEAM, ALPHA, COPIES = 4096, 2048, 32, 128, 1.2, 64
BUILD_BEAM, BATCH, WIDTH, ENTRIES = 64, 256, 4, 8
MOST_TASKS = 20_000
INDEX = "shard int, node int, v array<double>, ids array<long>, edges array<int>, entry boolean"
RESULT = "query_id long, rank int, vec_id long, score double"


def vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) of the rows that take part, components as doubles."""
    v = F.col(vec_col)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    some = F.exists(v, lambda x: x != 0)
    rows = df.filter(F.col(id_col).isNotNull() & v.isNotNull() & ~odd & some)
    return rows.select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("v"))


def _matrix(column) -> np.ndarray:
    """Rows of a list<double> column, padded with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), max(int(lengths.max(initial=0)), 1)))
    out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _widened(a: np.ndarray, dim: int) -> np.ndarray:
    return np.pad(a, ((0, 0), (0, dim - a.shape[1])))


class Graph:
    """A shard's nodes on one sphere and their edges; row ``n`` is the node that stands for none."""

    def __init__(self, points: np.ndarray, edges: np.ndarray | None = None, entries: np.ndarray | None = None) -> None:
        own = (points**2).sum(axis=1)
        largest = float(own.max(initial=0.0)) or 1.0
        lifted = np.concatenate([points, np.sqrt(np.maximum(largest - own, 0))[:, None]], axis=1) / np.sqrt(largest)
        self.n = len(points)
        self.points = np.concatenate([lifted, np.zeros((1, lifted.shape[1]))]).astype(np.float32)
        self.edges = np.full((self.n + 1, DEGREE), self.n, np.int32) if edges is None else edges
        self.entries = entries

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, similarities) of each query's ``beam`` best found, best first; none is ``n`` at minus infinity."""
        n, q = self.n, len(queries)
        queries = queries.astype(np.float32)
        nodes = np.full((q, beam), n, np.int32)
        sims = np.full((q, beam), -np.inf, np.float32)
        done = np.ones((q, beam), bool)
        seen = np.zeros((q, n + 1), bool)
        first = self.entries[: min(beam, len(self.entries))]
        nodes[:, : len(first)], sims[:, : len(first)], done[:, : len(first)] = first, queries @ self.points[first].T, False
        seen[:, first] = True
        seen[:, n] = True
        active = np.arange(q)
        while True:
            active = active[~done[active].all(axis=1)]
            if not len(active):
                return nodes, sims
            mine = ~done[active]
            pick = np.argsort(~mine, axis=1, kind="stable")[:, :WIDTH]
            open_ = np.take_along_axis(mine, pick, 1)
            chosen = np.where(open_, np.take_along_axis(nodes[active], pick, 1), n)
            done[active[:, None], pick] = True
            found = np.sort(self.edges[chosen].reshape(len(active), -1), axis=1)
            found[:, 1:][found[:, 1:] == found[:, :-1]] = n
            found[seen[active[:, None], found]] = n
            at, col = np.nonzero(found < n)
            if not len(at):
                continue
            fresh = np.full(found.shape, -np.inf, np.float32)
            fresh[at, col] = np.einsum("nd,nd->n", queries[active[at]], self.points[found[at, col]])
            seen[active[at], found[at, col]] = True
            every = np.concatenate([sims[active], fresh], axis=1)
            best = np.argsort(-every, axis=1, kind="stable")[:, :beam]
            sims[active] = np.take_along_axis(every, best, 1)
            nodes[active] = np.take_along_axis(np.concatenate([nodes[active], found], axis=1), best, 1)
            fresh_done = np.concatenate([done[active], fresh == -np.inf], axis=1)
            done[active] = np.take_along_axis(fresh_done, best, 1)

    def prune(self, owners: np.ndarray, proposed: np.ndarray, alpha: float) -> np.ndarray:
        """At most ``DEGREE`` edges of every owner, from its proposals."""
        n = self.n
        proposed = np.sort(proposed, axis=1)
        proposed[:, 1:][proposed[:, 1:] == proposed[:, :-1]] = n
        proposed[proposed == owners[:, None]] = n
        near = self.points[proposed]
        dist = 2 - 2 * np.einsum("bd,bcd->bc", self.points[owners], near)
        dist[proposed == n] = np.inf
        order = np.argsort(dist, axis=1, kind="stable")
        proposed, dist = np.take_along_axis(proposed, order, 1), np.take_along_axis(dist, order, 1)
        near = self.points[proposed]
        between = np.maximum(2 - 2 * np.matmul(near, near.transpose(0, 2, 1)), 0)
        alive = proposed < n
        rows = np.arange(len(owners))
        out = np.full((len(owners), DEGREE), n, np.int32)
        for slot in range(DEGREE):
            nearest = alive.argmax(axis=1)
            has = alive[rows, nearest]
            if not has.any():
                break
            out[:, slot] = np.where(has, proposed[rows, nearest], n)
            alive &= ~(has[:, None] & (alpha**2 * between[rows, nearest] <= dist))
            alive[rows, nearest] = False
        return out

    def _enter_backwards(self, owners: np.ndarray, edges: np.ndarray, alpha: float) -> None:
        source, target = np.repeat(owners, edges.shape[1]), edges.ravel()
        source, target = source[target < self.n], target[target < self.n]
        known = (self.edges[target] == source[:, None]).any(axis=1)
        source, target = source[~known], target[~known]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, first, counts = np.unique(target, return_index=True, return_counts=True)
        held = (self.edges[nodes] < self.n).sum(axis=1)
        place = np.arange(len(target)) - np.repeat(first, counts)
        fits = np.repeat(held + counts <= DEGREE, counts)
        self.edges[target[fits], (np.repeat(held, counts) + place)[fits]] = source[fits]
        full = np.flatnonzero(held + counts > DEGREE)
        full = full[np.argsort(counts[full], kind="stable")]
        while len(full):
            step = max(1, (1 << 22) // int((DEGREE + counts[full[: BATCH]].max()) ** 2))
            some, full = full[: min(step, BATCH)], full[min(step, BATCH) :]
            proposed = np.full((len(some), DEGREE + int(counts[some].max())), self.n, np.int32)
            proposed[:, :DEGREE] = self.edges[nodes[some]]
            for row, k in enumerate(some):
                proposed[row, DEGREE : DEGREE + counts[k]] = source[first[k] : first[k] + counts[k]]
            self.edges[nodes[some]] = self.prune(nodes[some], proposed, alpha)

    def build(self, alpha: float, beam: int, seed: int = 1) -> Graph:
        """Edges of all nodes, by insertion and one pass of refinement."""
        order = np.random.default_rng(seed).permutation(self.n).astype(np.int32)
        mean = self.points[:-1].mean(axis=0)
        middle = int((self.points[:-1] @ mean).argmax())
        order = np.concatenate([np.array([middle], np.int32), order[order != middle]])
        self.entries = order[:ENTRIES]
        at = min(len(order), 64)
        start = order[:at]
        self.edges[start] = self.prune(start, np.tile(start, (at, 1)), alpha)
        while at < len(order):
            batch = order[at : at + min(at, BATCH)]
            self._propose(batch, alpha, beam, None)
            at += len(batch)
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            self._propose(batch, alpha, beam, self.edges[batch])
        return self

    def _propose(self, batch: np.ndarray, alpha: float, beam: int, held: np.ndarray | None) -> None:
        found, _ = self.search(self.points[batch], beam)
        self.edges[batch] = self.prune(batch, found if held is None else np.concatenate([found, held], axis=1), alpha)
        self._enter_backwards(batch, self.edges[batch], alpha)


def _build_shard(alpha: float, beam: int):
    def run(rows: pa.Table) -> pa.Table:
        graph = Graph(_matrix(rows.column("v"))).build(alpha, beam)
        edges = graph.edges[:-1]
        kept = edges < graph.n
        offsets = np.concatenate([[0], np.cumsum(kept.sum(axis=1))]).astype(np.int32)
        entry = np.zeros(graph.n, bool)
        entry[graph.entries] = True
        columns = [rows.column("shard").cast(pa.int32()), pa.array(np.arange(graph.n), pa.int32()), rows.column("v"), rows.column("ids"),
                   pa.ListArray.from_arrays(pa.array(offsets), pa.array(edges[kept], pa.int32())), pa.array(entry)]
        return pa.table(columns, names=["shard", "node", "v", "ids", "edges", "entry"])

    return run


def build_index(rows: DataFrame, shard: int = SHARD, alpha: float = ALPHA, beam: int = BUILD_BEAM, copies: int = COPIES) -> DataFrame:
    """shard, node, v, ids, edges, entry of every distinct vector of ``rows(id, v)``, written once."""
    smallest = Window.partitionBy("v").orderBy("id")
    ids = rows.select("v", "id").distinct().withColumn("r", F.row_number().over(smallest)).filter(F.col("r") <= copies)
    nodes = materialize(ids.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "nodes")
    shards = max(1, ceil(nodes.count() / shard))
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int"))
    # A number of partitions of its own: merged by their few bytes, many shards would be built by one task.
    dealt = dealt.repartition(min(shards, MOST_TASKS), "shard")
    return materialize(dealt.groupBy("shard").applyInArrow(_build_shard(alpha, beam), INDEX), "graph")


def _search_shard(k: int, beam: int):
    """The best k ids of one shard for every query of a block."""

    def run(asked: pa.Table, index: pa.Table) -> pa.Table:
        out: list[tuple[int, int, float]] = []
        if asked.num_rows and index.num_rows:
            index = index.sort_by("node")
            points, queries = _matrix(index.column("v")), _matrix(asked.column("v"))
            dim = max(points.shape[1], queries.shape[1])
            points, queries = _widened(points, dim), _widened(queries, dim)
            edges = np.full((len(points) + 1, DEGREE), len(points), np.int32)
            lists = index.column("edges").combine_chunks()
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            edges[:-1][np.arange(DEGREE)[None, :] < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
            graph = Graph(points, edges, np.flatnonzero(index.column("entry").to_numpy()).astype(np.int32))
            norms = np.sqrt((queries**2).sum(axis=1))[:, None]  # directions alone decide, whatever a query's length
            lifted = np.concatenate([queries / norms, np.zeros((len(queries), 1))], axis=1)
            ids, qids = index.column("ids").to_pylist(), asked.column("id").to_pylist()
            for at in range(0, len(qids), BATCH):
                found, _ = graph.search(lifted[at : at + BATCH], max(beam, 2 * k))
                for row, q in zip(found, range(at, at + len(found)), strict=True):
                    row = row[row < graph.n]
                    scores = points[row] @ queries[q]
                    best, qid = [], qids[q]
                    least = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1] if len(scores) > k else -np.inf
                    for node in np.flatnonzero(scores >= least):
                        best += [(-float(scores[node]), i) for i in ids[row[node]] if i != qid]
                    out += [(qid, i, -s) for s, i in sorted(best)[:k]]
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        types = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["query_id", "vec_id", "score"])

    return run


def search(index: DataFrame, queries: DataFrame, k: int = 20, beam: int = BEAM, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest k found for ``queries(id, v)``; k must be less than the index's ``copies``."""
    spark = index.sparkSession
    shards = index.agg(F.max("shard")).first()[0]
    asked = materialize(queries.groupBy("id").agg(F.min("v").alias("v")), "asked")
    blocks = ceil(asked.count() / block)
    if shards is None or not blocks:
        return spark.createDataFrame([], RESULT)
    of_block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    every = asked.select(F.explode(F.sequence(F.lit(0), F.lit(shards))).alias("shard"), of_block.alias("block"), "id", "v")
    each = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    tasks = min((shards + 1) * blocks, MOST_TASKS)
    found = (
        every.repartition(tasks, "shard", "block").groupBy("shard", "block")
        .cogroup(each.repartition(tasks, "shard", "block").groupBy("shard", "block"))
        .applyInArrow(_search_shard(k, beam), "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
