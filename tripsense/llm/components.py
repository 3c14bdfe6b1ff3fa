"""Connected components of a graph given as an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripsense.llm.common import cut

SALTS = 64


def _settled(edges: DataFrame) -> bool:
    """Whether every node is either a root or points at one: no ``a`` stands twice, and none is a ``b``."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("points"), F.lit(0).alias("met")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("points"), F.lit(1).alias("met")),
    )).alias("end")).groupBy("end.node").agg(F.sum("end.points").alias("points"), F.max("end.met").alias("met"))
    return not ends.agg(F.max((F.col("points") > 1) | ((F.col("points") > 0) & (F.col("met") > 0)))).first()[0]


def _with_low(pairs: DataFrame, low: Column) -> DataFrame:
    """``pairs`` with ``low``, an aggregate over the pairs of each ``a``.

    The pairs of an ``a`` are dealt to ``SALTS`` parts. Parts are aggregated before nodes, and what a node gets goes back to
    its parts, so a node with very many neighbours is gathered nowhere.
    """
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
    parts = salted.groupBy("a", "salt").agg(F.min("b").alias("b"))
    nodes = parts.groupBy("a").agg(low.alias("low"))
    return salted.join(parts.select("a", "salt").join(nodes, "a"), ["a", "salt"]).drop("salt")


def _star(edges: DataFrame, *, large: bool) -> DataFrame:
    """Points neighbours of a node at the smallest one: those above the node (large), or those not above it (small)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if large:
        moved = _with_low(both, F.least(F.min("b"), F.col("a"))).filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        down = _with_low(both.filter("b < a"), F.min("b"))
        moved = down.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(down.select("a", F.col("low").alias("b")))
    return moved.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of an edge, the root being the smallest node that can be reached.

    ``edges`` has two long columns ``a`` and ``b``; nulls and loops are dropped, an empty table gives an empty one.
    Rounds repeat until every edge points at a root, each written to the shared checkpoint folder.
    """
    edges = cut(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    while not _settled(edges):
        edges = cut(_star(_star(edges, large=True), large=False))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
