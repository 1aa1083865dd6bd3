"""Connected components of a link table, as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has a link; the component is its
    smallest node.  Ids are longs, links have no direction, repeats and loops
    do no harm.

    Alternates two steps until the links no longer change: each node hangs its
    larger neighbours, then itself and its smaller ones, on the smallest node
    it knows, which leaves stars.  A step is a grouped minimum and a join, both
    with map-side or adaptive splitting for hot nodes, and takes a number of
    rounds that grows with the logarithm of the nodes.
    """
    edges = stage(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").dropDuplicates(), "links")
    known = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        # larger neighbours go to the smallest one known
        large = both.where("v > u").join(low, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u <> v").dropDuplicates(), "links")
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
        # every link now points from a larger to a smaller node
        small = large.join(low, F.col("u") == F.col("w"))
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        edges = stage(small.where("u <> v").dropDuplicates(), "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == known:
            break
        known = state
    tops = edges.select(F.col("v").alias("node")).dropDuplicates().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops)
