"""Connected components of a table of links, as rounds of joins and sums; no links come to the driver."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.session import work_table


def _both(links: DataFrame) -> DataFrame:
    return links.union(links.select("b", "a"))


def _star(links: DataFrame, near: DataFrame) -> DataFrame:
    """Hang what ``near`` has around each node on the least node around it."""
    least = near.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return near.join(least, "a").select(F.col("b").alias("x"), F.col("a").alias("y"), "low")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node that can be reached.

    Alternates large stars (neighbours above a node) and small stars (below it) until nothing changes.  A node with
    very many links is summed in each task before the shuffle, and its rows in the join are split by adaptive execution.
    """
    spark = links.sparkSession
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = work_table(links, "links")
    before = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            break
        before = state
        large = _star(links, _both(links)).where("x > y").select(F.col("x").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.union(large.select("a", F.col("a").alias("b")))
        small = _star(large, down).select(F.col("x").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        links = work_table(small, "links")
    roots = links.groupBy("a").agg(F.min("b").alias("root"))
    tops = links.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return roots.select(F.col("a").alias("node"), "root").union(tops) if before else spark.createDataFrame([], "node long, root long")
