"""Connected components of a graph by alternating star operations; nothing but edges moves, and none through the
driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolcat.llm.common import join_groups, materialize


def _mins(pairs: DataFrame, total: int) -> DataFrame:
    """``a, b`` with ``m``, the least ``b`` of each ``a``; an ``a`` with very many edges is no hot spot."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("size"))
    return join_groups(pairs, least, "a", "size", total)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    total = 2 * edges.count()
    if large:  # every larger neighbour goes to the least of the neighbourhood
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        found = _mins(both, total).filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
    else:  # every smaller neighbour, and the node itself, go to the least of them
        found = _mins(edges, total).select(
            F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("x")
        )
        found = found.select(F.col("x.b").alias("a"), F.col("x.m").alias("b")).filter("a <> b")
    return materialize(found.distinct(), "edges")


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``, of one orderable type) that isn't the least of its
    component, which is the root. Self-loops and repeats do no harm; no edges give no rows."""
    larger = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = materialize(larger.distinct(), "edges")
    mark = None
    while True:
        edges = _star(_star(edges, large=True), large=False)
        new = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
        if new == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = new
