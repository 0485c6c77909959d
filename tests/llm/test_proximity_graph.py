"""The proximity graph against brute force."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest

from scanpress.llm import proximity
from scanpress.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, score string"


def _brute(rows, k, every=20):
    whole = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    asked = {}
    for i, v in whole:
        if i % every == 0:
            asked[i] = min(asked.get(i, v), v)
    dim = max(len(v) for _, v in whole)
    matrix = np.array([[*v, *[0.0] * (dim - len(v))] for _, v in whole])
    ids = np.array([i for i, _ in whole])
    out = {}
    for q, v in asked.items():
        scores = matrix @ np.array([*v, *[0.0] * (dim - len(v))])
        pairs = sorted({(-s, i, tuple(m)) for s, i, m in zip(scores.tolist(), ids.tolist(), matrix.tolist(), strict=True) if i != q})
        out[q] = [(i, -s) for s, i, _ in pairs[:k]]
    return out


def _recall(found, want, k):
    got = defaultdict(list)
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(got) == {q for q, best in want.items() if best}
    hits = total = 0
    for q, best in want.items():
        assert [n for n, _, _ in got[q]] == list(range(1, len(got[q]) + 1)) and len(got[q]) <= k
        assert [(-s, i) for _, i, s in got[q]] == sorted((-s, i) for _, i, s in got[q])
        exact = dict(best)
        assert all(s == pytest.approx(exact[i], abs=1e-12) for _, i, s in got[q] if i in exact)
        hits += len({i for _, i, _ in got[q]} & set(exact))
        total += len(best)
    return hits / max(total, 1)


def _rows():
    rng = np.random.default_rng(7)
    rows = [(k, v.tolist()) for k, v in enumerate(rng.normal(size=(1500, 24)) * rng.uniform(0.2, 3, (1500, 1)))]  # lengths differ
    centers = rng.normal(size=(20, 24)) * 2
    rows += [(2000 + k, (centers[k % 20] + rng.normal(size=24) * 0.01).tolist()) for k in range(800)]
    rows += [(5000 + k, [1.0] * 24) for k in range(900)]  # one common vector
    rows += [(40, [2.0, -3.0]), (60, rows[3][1]), (60, rows[3][1]), (9001, [1.5])]
    rows += [(9020, None), (9040, [1.0, None]), (9060, [float("nan")]), (9080, [float("inf")] * 24), (None, [1.0]), (9100, [0.0] * 24), (9120, [])]
    return rows


def test_recall_over_shards_and_blocks(spark):
    df = spark.createDataFrame([(i, v, "x") for i, v in _rows()], SCHEMA).repartition(4)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    data = proximity.vectors(df, "vec_id", "embedding")
    index = proximity.build_index(data, shard=500)
    assert index.agg({"shard": "max"}).first()[0] >= 3
    assert index.selectExpr("max(size(edges))", "max(size(ids))").first() == (proximity.DEGREE, proximity.COPIES)
    found = proximity.search(index, data.filter("id % 20 = 0"), k=20, block=60).collect()
    assert _recall(found, _brute(rows, 20), 20) >= 0.97


def test_common_vector_gives_its_smallest_ids(spark):
    rows = [(k, [1.0, 2.0]) for k in range(300)] + [(500, [1.0, 2.5])]
    data = proximity.vectors(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA), "vec_id", "embedding")
    found = proximity.search(proximity.build_index(data), data.filter("id % 20 = 0"), k=20).collect()
    assert _recall(found, _brute(rows, 20), 20) == 1.0


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(20, [1.0], "x"), (3, [2.0], "x")], SCHEMA)
    data = proximity.vectors(df, "vec_id", "embedding")
    index = proximity.build_index(data)
    assert [tuple(r) for r in proximity.search(index, data.filter("id = 20")).collect()] == [(20, 1, 3, 2.0)]
    assert proximity.search(index, data.limit(0)).count() == 0
    empty = proximity.build_index(data.limit(0))
    assert empty.count() == 0 and proximity.search(empty, data).count() == 0


def test_relaxed_pruning_keeps_the_nearest_and_diverse_edges():
    points = np.array([[0.0, 0.0], [1.0, 0.0], [1.1, 0.0], [0.0, 1.0], [3.0, 0.0]])
    graph = proximity.Graph(points)
    graph.points = np.concatenate([points, np.zeros((1, 2))]).astype(np.float32) / 3  # distances in the plane itself
    own = (graph.points**2).sum(axis=1)
    graph.points = np.concatenate([graph.points, np.sqrt(1 - own)[:, None]], axis=1)
    edges = graph.prune(np.array([0]), np.array([[1, 2, 3, 4, 0, 5]]), 1.2)[0]
    assert edges[edges < 5].tolist() == [1, 3]


def test_registered_search_has_the_neighbours(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    found = QUERIES["op13_proximity_graph"](spark, SF).collect()
    assert _recall(found, _brute(rows, 20), 20) >= 0.95
