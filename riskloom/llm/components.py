"""Connected components of a table of edges, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import join_counted
from riskloom.session import materialize


def _least(pairs: DataFrame) -> DataFrame:
    """(u, v, low): each pair with the least of u and its partners."""
    counted = pairs.groupBy("u").agg(F.min("v").alias("low"), F.count("*").alias("count"))
    counted = materialize(counted.withColumn("low", F.least("low", "u")), "components-least")
    total = counted.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    return join_counted(pairs, counted, "u", total).select("u", "v", "low")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (columns a, b of one ordered type); component is the least node.

    A round hangs the larger neighbours of each node below its least neighbour, then the smaller ones;
    the rounds end when the edges are stars. A node's neighbours are never gathered in one row, and
    nodes with very many edges are joined without a shuffle. Every round is stored, so that the plan
    stays short and lost executors cost one round.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    pairs = materialize(pairs.distinct(), "components")
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = materialize(large.where("u <> v").distinct(), "components-large")
        found = _least(large)
        small = found.select(F.col("v").alias("u"), F.col("low").alias("v"))
        small = small.unionByName(found.select("u", F.col("low").alias("v"))).where("u <> v").distinct()
        small = materialize(small, "components-small")
        # Stars: every node hangs on one other, and none that others hang on hangs itself.
        one = small.groupBy("u").agg(F.count("*").alias("n"))
        deep = small.select(F.col("v").alias("u")).distinct().join(one, "u", "left_semi").limit(1).count()
        many = one.where("n > 1").limit(1).count()
        pairs = small
        if not deep and not many:
            break
    leaves = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(leaves.select(F.col("component").alias("node"), "component").distinct())
