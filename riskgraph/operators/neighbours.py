"""One-degree contact lists: out-, in- and all neighbours of each mobile.

The primary result is the long form ``(mobile, neighbour)``: distinct pairs,
hash-partitioned on both columns, so a hub number with millions of contacts
is spread over many tasks.  The adjacency form (one row per mobile with its
sorted neighbours) exists only for the text sink, whose format is one line per
mobile.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.operators.edges import reverse_edges

# Partial lists of a mobile that are collected apart before they meet in its line.
PARTS = 32


def out_neighbours(edges: DataFrame) -> DataFrame:
    """A6 (long form): distinct (mobile, neighbour) from caller to callee."""
    return edges.select(F.col("src").alias("mobile"), F.col("dst").alias("neighbour")).distinct()


def in_neighbours(edges: DataFrame) -> DataFrame:
    """A7 (long form): distinct (mobile, neighbour) from callee to caller."""
    return out_neighbours(reverse_edges(edges.select("src", "dst")))


def both_directions(edges: DataFrame) -> DataFrame:
    """Bag union of the out- and in-adjacency.  Both directions come out
    of one pass over the edges (``explode`` of the pair and its reverse)."""
    both = F.explode(F.array(
        F.struct(F.col("src").alias("mobile"), F.col("dst").alias("neighbour")),
        F.struct(F.col("dst").alias("mobile"), F.col("src").alias("neighbour"))))
    return edges.select(both.alias("p")).select("p.mobile", "p.neighbour")


def all_neighbours(edges: DataFrame) -> DataFrame:
    """A8 (long form): in- and out-neighbours merged into one set per mobile."""
    return both_directions(edges).distinct()


def adjacency(pairs: DataFrame) -> DataFrame:
    """Rows (mobile, neighbours: sorted array<string>) from distinct long-form
    pairs, exactly one per mobile.  A mobile's names are collected in
    ``PARTS`` hashed parts, in different tasks; only the finished parts of one
    line meet, as its format asks."""
    return (pairs.groupBy("mobile", F.pmod(F.xxhash64("neighbour"), F.lit(PARTS)).alias("part"))
            .agg(F.collect_list("neighbour").alias("names"))
            .groupBy("mobile").agg(F.array_sort(F.flatten(F.collect_list("names"))).alias("neighbours")))


def one_degree(rank_edges: DataFrame, directed: bool = True, distinct_pairs: bool = False) -> DataFrame:
    """C23 (``directed=True``: callees per caller) and C24 (in and out merged):
    rows (mobile, neighbours) ready for the tab-separated adjacency sink.
    ``distinct_pairs=True`` says the edges are already distinct (as ranking
    pairs are), which saves the distinct of the directed form."""
    if not directed:
        return adjacency(all_neighbours(rank_edges))
    if distinct_pairs:
        return adjacency(rank_edges.select(F.col("src").alias("mobile"), F.col("dst").alias("neighbour")))
    return adjacency(out_neighbours(rank_edges))
