"""Connected components of an edge table by alternating large and small stars.

Per round every edge is drawn to the smallest neighbour known, so trees
flatten in a logarithmic number of rounds.  A node's neighbours are never
collected: the minimum per node is an aggregate with map-side combine, joined
back to the edges, so a node with very many neighbours stays spread out.  Each
round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanpress.llm.common import materialize


def _pull(edges: DataFrame, own: bool) -> DataFrame:
    """(u, v, m): ``m`` the smallest of u's neighbours (and, if ``own``, of u itself)."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(low, "u")
    return joined.withColumn("m", F.least("u", "m")) if own else joined


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _pull(both, own=True).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    pulled = _pull(down, own=False)
    others = pulled.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    selves = pulled.select("u", F.col("m").alias("v"))
    return others.unionByName(selves).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(u long, v long)``; component is the smallest node reachable."""
    edges = materialize(edges.filter("u <> v").distinct(), "edges")
    before = None
    while True:
        edges = materialize(_small_star(_large_star(edges)), "stars")
        # Stable once every edge ends in a node that no edge leaves and a round changes nothing.
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
