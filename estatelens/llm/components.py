"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.llm.shared import BROADCAST_BYTES, cut, shuffle_partitions


def _least(edges: DataFrame, few: bool) -> DataFrame:
    """Each ``a`` with its least neighbour (itself included).  A few are sent
    to every executor; more are redistributed into as many parts as a
    shuffle has, so that a join exchanges both sides and skewed keys split."""
    low = edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("low"))
    return F.broadcast(low) if few else low.repartition(shuffle_partitions(edges))


def _large_star(edges: DataFrame, few: bool) -> DataFrame:
    """At most one row an edge, so it need not be made distinct."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return (both.join(_least(both, few), F.col("a") == F.col("node")).where("b > a")
            .select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b"))


def _small_star(down: DataFrame, few: bool) -> DataFrame:
    """(a, b, moved) of edges with b < a.  ``moved`` are those of a node with
    other lesser neighbours or whose neighbour has a lesser one; without any
    ``down`` is stars around least nodes, and so is the result."""
    least = _least(down, few)
    lesser = least.select(F.col("node").alias("b_node"))
    joined = (down.join(least, F.col("a") == F.col("node")).join(lesser, F.col("b") == F.col("b_node"), "left")
              .select("a", "b", "low", ((F.col("b") != F.col("low")) | F.col("b_node").isNotNull()).alias("moved")))
    pairs = F.array(F.struct(F.col("a").alias("from"), F.col("low").alias("to")), F.struct(F.col("b").alias("from"), F.col("low").alias("to")))
    return (joined.select(F.explode(pairs).alias("e"), "moved").where("e.from <> e.to")
            .groupBy(F.col("e.from").alias("a"), F.col("e.to").alias("b")).agg(F.max("moved").alias("moved")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b longs): ``root`` is the
    least node reachable.  Nodes without an edge to another are left out.

    Edges stay distributed; each step is written to the shared folder.  As
    long as the nodes may be many, a star's centre is joined with both sides
    exchanged, so it is split; least neighbours of a few are broadcast."""
    edges = cut(edges.where("a <> b").distinct())
    while True:
        few = 2 * edges.count() * 16 <= BROADCAST_BYTES
        step = cut(_small_star(cut(_large_star(edges.select("a", "b"), few)), few))
        if step.where("moved").isEmpty():
            return step.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                step.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        edges = step
