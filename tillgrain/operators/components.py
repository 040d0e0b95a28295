"""Connected components of an undirected graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize, scratch
from .joins import attach


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b); the smallest node names it.

    Alternating star contractions: each node hands its larger neighbours, then its
    smaller ones, to the least node around it.  The number of rounds grows with the
    logarithm of the graph, not with its diameter.  Every round is stored, and nodes
    with many neighbours are joined as hot keys.  The result is stored, the rounds are deleted.
    """
    with scratch(edges.sparkSession) as scope:
        return scope.keep(_contracted(edges), "components")


def _contracted(edges: DataFrame) -> DataFrame:
    edges = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .filter("a <> b").distinct(), "edges")
    nodes = materialize(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
    while not _is_stars(edges):
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = _contract(_contract(both, F.col("b") > F.col("a")), F.lit(True))
    return nodes.join(edges, F.col("node") == F.col("a"), "left").select(
        "node", F.coalesce("b", F.col("node")).alias("component"))


def _is_stars(edges: DataFrame) -> bool:
    """Every node has one edge, and it leads to a node without an edge of its own."""
    facts = edges.agg(F.count("*").alias("n"), F.countDistinct("a").alias("nodes")).first()
    if facts["n"] != facts["nodes"]:
        return False
    inner = edges.select(F.col("a").alias("b"))
    return edges.join(inner, "b", "left_semi").isEmpty()


def _contract(edges: DataFrame, moved) -> DataFrame:
    """Link the neighbours b of each node a (those `moved`) to the least node around a.

    The node itself is linked too, so no path is lost.  Result edges point from the
    larger to the smaller node.
    """
    least = materialize(edges.groupBy("a").agg(
        F.least(F.min("b"), F.col("a")).alias("least"), F.count("*").alias("degree")), "least")
    joined = attach(edges, least, "a", "degree").filter(moved)
    linked = joined.select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select("a", F.col("least").alias("b"))
    return materialize(linked.unionAll(own).filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
