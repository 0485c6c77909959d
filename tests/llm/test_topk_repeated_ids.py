"""op1 where rows repeat the id of a query."""

from __future__ import annotations

import math
import random

from scanpress.llm import topk


def _found(spark, rows, k, **sizes):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    data = topk.quantised(df, "vec_id", "embedding", scale=1)
    return sorted(tuple(r) for r in topk.voronoi_topk(data, data.filter("id % 50 = 0"), k, **sizes).collect())


def test_repeated_query_id_keeps_its_neighbour(spark):
    # The only pivots are the query's own vector and far from the neighbour's.
    for pivots in (1, 2, 64):
        assert _found(spark, [(50, [2.0]), (50, [2.0]), (3, [1.0])], 1, pivots=pivots) == [(50, 1, 3, 2)]


def test_many_rows_of_queried_ids_equal_brute_force(spark):
    rng = random.Random(11)
    rows = [(k % 37 + 1, [float(rng.randint(-40, 40)) for _ in range(3)]) for k in range(300)]
    for query in (50, 100, 150):  # rows of the query's own id lie nearest to it
        top = [float(rng.randint(60, 90)) for _ in range(3)]
        rows += [(query, [x + rng.randint(-1, 1) for x in top]) for _ in range(12)]
    rows += [(query, [-5.0, -5.0, -5.0]) for query in (50, 150)]
    want = []
    for query in (50, 100, 150):
        v = min([math.floor(x) for x in w] for i, w in rows if i == query)
        scored = sorted((-sum(int(a * b) for a, b in zip(v, w, strict=True)), i) for i, w in rows if i != query)
        want += [(query, r + 1, i, -s) for r, (s, i) in enumerate(scored[:5])]
    for pivots in (2, 8, 64):
        assert _found(spark, rows, 5, pivots=pivots, block=2, slice_rows=7) == sorted(want)
