"""Connected components of a graph given as a table of edges, by DataFrame operations only.

Alternates two steps until only stars are left: every node hands its smallest neighbour to its
larger neighbours, then to its smaller ones. Edges end as stars around the smallest node of
each component, in a number of rounds that grows with the logarithm of its size. A hub's
minimum is pre-aggregated before the shuffle, and its edges are joined with that one row, a
skewed join that Spark splits. Every round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.session import materialize


def _star(neighbours: DataFrame) -> DataFrame:
    """Each (``a``, ``b``) with ``least``, the smallest of ``a`` and all its ``b``."""
    smallest = neighbours.groupBy("a").agg(F.min("b").alias("least"))
    smallest = smallest.select("a", F.least("a", "least").alias("least"))
    return neighbours.join(smallest, "a")


def _round(edges: DataFrame) -> DataFrame:
    """``edges`` have ``a`` > ``b``, and so has the result."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    larger = _star(both).filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    stars = _star(larger.distinct())
    smaller = stars.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
        stars.select("a", F.col("least").alias("b"))
    )
    return smaller.filter("a > b").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every larger end has one edge and is no smaller end."""
    one, none = F.lit(1), F.lit(0)
    ends = edges.select(F.col("a").alias("node"), one.alias("large"), none.alias("small")).union(
        edges.select("b", none, one)
    )
    nodes = ends.groupBy("node").agg(F.sum("large").alias("large"), F.max("small").alias("small"))
    return nodes.filter("large > 1 OR large = 1 AND small = 1").agg(F.count("node")).first()[0] == 0


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its component's smallest node, for every node of ``edges``
    (``a``, ``b``: one orderable type, nulls and loops are no edges).

    Nodes without an edge to another node are not in the result.
    """
    edges = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = materialize(edges.distinct(), "edges")
    while not _are_stars(edges):
        edges = materialize(_round(edges), "edges")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
