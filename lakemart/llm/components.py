"""Connected components of a table of links, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.session import new_table_path


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is linked with over any number of ``links`` (columns a, b).

    Every turn links each node and its neighbours to the smallest of them; the number of turns grows with the
    logarithm of the longest chain. Each turn's table is written, so a lost executor costs one turn at most. Nodes
    without links to others are left out.
    """
    spark = links.sparkSession
    links = links.where("a <> b").select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).distinct()
    before = None
    while True:
        path = new_table_path(spark, "links")
        links.write.parquet(path)
        links = spark.read.parquet(path)
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).distinct()
        before = state
        both = links.select(F.col("a").alias("node"), F.col("b").alias("next"))
        both = both.unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("next")))
        least = both.groupBy("node").agg(F.min("next").alias("least"))
        least = least.select("node", F.least("node", "least").alias("root"))
        moved = both.join(least, "node").select(F.col("next").alias("a"), F.col("root").alias("b"))
        moved = moved.unionByName(least.select(F.col("node").alias("a"), F.col("root").alias("b")))
        links = moved.where("a <> b").select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).distinct()
