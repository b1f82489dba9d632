"""Connected components by alternating large-star and small-star steps.

Each step is a join-free aggregate over the edges plus one join on the
neighbourhood minimum; the edge list only shrinks towards stars, so hubs do
not grow.  Every step is written to the shared folder, which cuts lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.llm.common import discard, stored


def _least(edges: DataFrame) -> DataFrame:
    """Per node u: the least of u and its neighbours."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.join(_least(both), "u").filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    m = _least(down)
    moved = down.join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = m.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).filter("u != v").distinct()


def _mark(edges: DataFrame) -> tuple:
    """Size and order-free checksum of the edge list."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """Component labels of the graph with edges (a, b): rows (id, label), one
    per node that has an edge; label is the smallest id of its component.  The
    result is a stored table.
    An edge from a node to itself adds nothing; repeated edges count once."""
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u != v")
    edges = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        older, edges = edges, stored(_small_star(_large_star(edges)), "edges")
        discard(older)
        after = _mark(edges)
        if after == mark:
            break
        mark = after
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct()
    labels = stored(edges.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(roots), "labels")
    discard(edges)
    return labels
