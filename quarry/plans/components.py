"""Connected components of an edge DataFrame, distributed.

Alternating large-star / small-star rounds (Kiveris et al., "Connected
Components in MapReduce and Beyond", SoCC 2014) expressed as DataFrame
aggregations and equi-joins. Edges are kept oriented ``(u, v)`` with
``u > v``. The fixed point is a star forest in which every node points to
the smallest id of its component. Each round is checkpointed into the
session's shared checkpoint folder so lineage stays one round long and a
lost executor only recomputes the current round. No group is ever
collected: a hub with millions of neighbours is a key of a partial
aggregation and of an AQE skew-split join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import checkpointed


def _oriented(edges: DataFrame) -> DataFrame:
    return (edges.filter(F.col("u") != F.col("v"))
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
            .distinct())


def _large_star(e: DataFrame) -> DataFrame:
    """Every node links its strictly larger neighbours to the smallest node
    of its closed neighbourhood."""
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    m = both.groupBy("u").agg(F.min("v").alias("mv")).select(
        "u", F.least("u", "mv").alias("m"))
    out = both.filter(F.col("v") > F.col("u")).join(m, "u").select(
        F.col("v").alias("u"), F.col("m").alias("v"))
    return _oriented(out)


def _small_star(e: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of
    them."""
    m = e.groupBy("u").agg(F.min("v").alias("m"))
    j = e.join(m, "u")
    out = j.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        m.select("u", F.col("m").alias("v")))
    return _oriented(out)


def _is_star_forest(e: DataFrame) -> bool:
    """Every node has at most one smaller neighbour, and that neighbour has
    none (it is a root). One job: violations of either kind, first one wins."""
    deg = e.groupBy("u").agg(F.count(F.lit(1)).alias("d"))
    multi = deg.filter(F.col("d") > 1).select(F.lit(1).alias("x"))
    chained = e.join(deg.select(F.col("u").alias("v")), "v", "left_semi").select(F.lit(1).alias("x"))
    return multi.union(chained).limit(1).count() == 0


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst",
                         max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` for every node that occurs in an edge;
    ``component`` is the smallest node id of its connected component. Ids may
    be of any type that has an order."""
    e = checkpointed(_oriented(edges.select(F.col(src).alias("u"), F.col(dst).alias("v"))))
    for _ in range(max_rounds):
        if _is_star_forest(e):
            break
        e = checkpointed(_small_star(_large_star(e)))
    else:
        raise RuntimeError("connected components did not converge")
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component")))
