"""Connected components of a distributed link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.tables import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """Smallest reachable node of each linked node, as ``(node, component)``.

    ``links`` has two integer columns ``a`` and ``b``; direction, repeats and links of a node to
    itself do not matter, links with a null end are ignored. Nodes without a link to another node
    do not appear in the result.

    Alternates large and small stars (Kiveris et al., "Connected Components in MapReduce and
    Beyond"). Each round is written to the shared scratch folder. The smallest neighbour per node
    is combined map-side, and it is written before it is joined so that Spark can split the join
    on a node with very many links.
    """
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    # greatest and least skip nulls, which makes a half-null link a link to itself
    edges = materialize(ordered.where("a <> b").distinct(), "links")
    while not _settled(edges):
        edges = materialize(_small_star(_large_star(edges)), "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select("b", "b").distinct()
    )


def _settled(edges: DataFrame) -> bool:
    """Whether all links lead from a node to the middle of its star: no node has two links to a
    smaller one, or both one to a smaller and one from a larger node."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"))
    ends = ends.union(edges.select("b", F.lit(0)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    return nodes.where("up > 1 or (up = 1 and least = 0)").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of the node and its neighbours."""
    around = edges.union(edges.select("b", "a"))
    smallest = around.groupBy("a").agg(F.min("b").alias("m"))
    smallest = materialize(smallest.select("a", F.least("a", "m").alias("m")), "smallest")
    linked = around.where("b > a").join(smallest, "a")
    return materialize(linked.select(F.col("b").alias("a"), F.col("m").alias("b")), "star")


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of these."""
    smallest = materialize(edges.groupBy("a").agg(F.min("b").alias("m")), "smallest")
    linked = edges.join(smallest, "a").where("b <> m")
    return (
        linked.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .union(smallest.select("a", F.col("m").alias("b")))
        .distinct()
    )
