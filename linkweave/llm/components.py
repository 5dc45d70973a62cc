"""Connected components by alternating large and small stars, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm.common import partitions, spread_join, written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the smallest node of its component.

    Each round hangs the larger neighbours of a node on its smallest one, then
    the smaller ones, until nothing changes, which takes some log(nodes)
    squared rounds at most. Edges are written to the shared folder each round;
    only counts and sums come to the driver. A node with very many neighbours,
    as the root of a large component is, has them dealt to many tasks.
    """
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    if now.isEmpty():
        return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    salts, seen = partitions(edges), None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = spread_join(both.where("v > u"), lowest, "u", ("v",), salts, "inner").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = written(large, "large-star")
        # The smaller neighbours of a node: few, since after a large star they lie on few roots.
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(lowest.select("u", F.col("m").alias("v")))
        now = written(small.where("u <> v").distinct(), "small-star")
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if mark == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark
