"""Connected components with alternating large-star / small-star rounds.

Kiveris et al., "Connected Components in MapReduce and Beyond" (SoCC 2014): each round is
two aggregations and two joins over the edge table, the number of rounds grows with
log(n), and no step gathers a component or a neighbour list into one task (minimum
labels are computed with partial aggregation). Each round's edge table is cut from its
lineage with a reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _sym(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.where(F.col("u") != F.col("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    s = _sym(edges)
    m = s.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    out = s.where(F.col("v") > F.col("u")).join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where(F.col("u") != F.col("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    s = _sym(edges)
    low = s.where(F.col("v") < F.col("u"))
    m = low.groupBy("u").agg(F.min("v").alias("m"))
    spokes = low.join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = spokes.unionByName(m.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def connected_components(nodes: DataFrame, edges: DataFrame, node: str = "node") -> DataFrame:
    """Label every node with the smallest node id of its component.

    ``nodes``: column ``node``; ``edges``: columns ``src, dst`` (undirected). Output ``(node, label)``.
    """
    e = edges.select(F.col("src").alias("u"), F.col("dst").alias("v")).where(F.col("u") != F.col("v"))
    e = cut_lineage(e.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    while True:
        e = cut_lineage(_small_star(_large_star(e)))
        # Both star operations emit edges (larger -> smaller). The labels are final exactly when
        # the graph is a set of stars: every node has at most one outgoing edge and no edge points
        # at a node that itself has an outgoing edge (a depth-1 forest rooted at the minima).
        children = e.select(F.col("u").alias("v")).distinct()
        deep = e.join(children, "v", "left_semi").limit(1).count()
        multi = 0 if deep else e.groupBy("u").count().where(F.col("count") > 1).limit(1).count()
        if deep == 0 and multi == 0:
            break
    labels = _sym(e).groupBy(F.col("u").alias(node)).agg(F.min("v").alias("label"))
    out = nodes.select(node).distinct().join(labels, node, "left")
    return out.select(node, F.least(F.col(node), F.coalesce(F.col("label"), F.col(node))).alias("label"))
