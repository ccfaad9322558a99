"""Connected components of an undirected graph by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component: smallest node in reach.

    Every round each node points at its smallest neighbour if that is smaller, pointers are
    doubled until they reach a root, and the edges are contracted to the roots: whole trees
    shrink to a node, so the rounds are logarithmic.  All joins are on node ids (a hub is
    split by Spark's skew handling), and every round is a table in the scratch folder.
    """
    left = materialize(edges.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    label = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = materialize(both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.min("b"), F.col("a")).alias("up")), "parents")
        while True:
            above = parent.select(F.col("node").alias("up"), F.col("up").alias("higher"))
            parent = materialize(parent.join(above, "up").select("node", F.col("higher").alias("up"),
                                                                 (F.col("higher") != F.col("up"))
                                                                 .alias("moved")), "parents")
            if parent.where("moved").isEmpty():
                break
            parent = parent.drop("moved")
        parent = parent.drop("moved")
        if label is None:
            label = parent.select("node", F.col("up").alias("component"))
        else:
            moved = parent.select(F.col("node").alias("component"), "up")
            label = materialize(label.join(moved, "component", "left").select(
                "node", F.coalesce("up", "component").alias("component")), "labels")
        to = parent.select(F.col("node").alias("a"), F.col("up").alias("a2"))
        left = (left.join(to, "a").select("b", "a2")
                .join(to.toDF("b", "b2"), "b").where("a2 <> b2"))
        left = materialize(left.select(F.least("a2", "b2").alias("a"),
                                       F.greatest("a2", "b2").alias("b")).distinct(), "edges")
    if label is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return label
