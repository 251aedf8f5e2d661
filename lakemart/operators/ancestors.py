"""Ancestors in a hierarchy that gives only the parent of each node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.session import new_table_path


def ancestors(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """``node``, ``ancestor`` and ``distance`` (1 for the parent) for every ancestor of every node.

    Every turn doubles the distance that is known: the ancestors at exactly the greatest one are joined with all that is
    known of them, so a hierarchy of depth d takes about log2(d) turns and a line of parents gives every pair once. A node
    has as many rows as it has ancestors, so a node high up is met by many rows but adds few to each. On a cycle every
    other node of it is an ancestor, at its least distance, and a node is never its own. A parent that is no node itself
    still is an ancestor; null parents end a line, and rows without a node are left out. A node with several parents has
    the ancestors of all. Each turn's new rows are written, once, so a lost executor costs one turn at most.
    """
    spark = nodes.sparkSession
    known = nodes.select(F.col(node).alias("node"), F.col(parent).alias("ancestor"), F.lit(1).alias("distance"))
    known = known.where("node IS NOT NULL AND ancestor IS NOT NULL AND node <> ancestor").distinct()
    paths, reach = [], 1
    while True:
        paths.append(new_table_path(spark, "ancestors"))
        known.write.parquet(paths[-1])
        everything = spark.read.parquet(*paths)
        # the newest rows hold the distances above half of reach, all others are nearer
        edge = spark.read.parquet(paths[-1]).where(F.col("distance") == reach)
        if edge.isEmpty():
            return everything.select(F.col("node").alias(node), "ancestor", "distance")
        up = everything.select(F.col("node").alias("_via"), F.col("ancestor").alias("_above"), "distance")
        further = edge.select("node", F.col("ancestor").alias("_via")).join(up, "_via").where("node <> _above")
        further = further.groupBy("node", F.col("_above").alias("ancestor")).agg(F.min("distance").alias("_more"))
        further = further.select("node", "ancestor", (F.col("_more") + F.lit(reach)).alias("distance"))
        known = further.join(everything.select("node", "ancestor"), ["node", "ancestor"], "left_anti")
        reach *= 2
