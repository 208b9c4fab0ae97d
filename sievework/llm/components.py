"""Connected components by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import written


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Links each node's neighbours (the larger ones, or in a small step the smaller ones and the
    node itself) to the smallest of them."""
    if small:
        around = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = around.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    linked = around.join(least, "u")
    if small:
        own = least.select("u", F.col("m").alias("v"))
        moved = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own)
    else:
        moved = linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for every node of ``edges`` (``u``, ``v``).

    Neighbour lists never meet in a task: each step is a minimum per node, combined before the
    shuffle, and a join that the engine splits where it is skewed. Ends when every node hangs on
    its root, after about log(nodes) steps.
    """
    now = written(edges.filter("u <> v").distinct(), "links")
    while True:
        now = written(_star(_star(now, small=False), small=True), "links")
        # finished when there are stars only: no node is under two others, or under one and a root
        ends = now.select("u", F.lit(1).alias("under"), F.lit(0).alias("root")).unionByName(
            now.select(F.col("v").alias("u"), F.lit(0).alias("under"), F.lit(1).alias("root"))
        )
        places = ends.groupBy("u").agg(F.sum("under").alias("under"), F.max("root").alias("root"))
        if places.filter((F.col("under") > 1) | ((F.col("under") == 1) & (F.col("root") == 1))).isEmpty():
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
