"""Connected components by alternating stars: every round is a few joins and aggregations of the links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navspan.llm.shared import written


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """Of links (a, b): each node that has one, and the smallest node that it reaches: (node, root).

    Each round ties a node's larger neighbours to its smallest one, then its smaller ones; the rounds needed grow
    with the logarithm of the number of nodes. Aggregations combine before the shuffle, and joins on a node with
    very many links are split by the adaptive skew join. Rounds are written to the shared folder.
    """
    links = links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct()
    links = written(spark, links, "links")
    seen = None
    while True:
        state = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
        if state == seen or not state[0]:
            return links.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
                links.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
        seen = state
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            links.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi")
        links = small.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(
            small.select("hi", F.col("m").alias("lo"))).where("hi <> lo").distinct()
        links = written(spark, links, "links")
