"""Connected components of links between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import spool


def components(links: DataFrame) -> DataFrame:
    """For links (a, b) of longs, each id that is linked and its ``root``, the smallest id reachable.

    Alternates two steps until every id points to its root: neighbours above
    an id are linked to the least neighbour, then an id and its smaller
    neighbours are. Each round is written to the shared folder. No links give
    no rows; links of an id to itself and repeated links do not count.
    """
    edges = spool(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        larger = both.where("v > u").join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smaller = larger.groupBy("u").agg(F.min("v").alias("m"))
        moved = larger.join(smaller, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = spool(moved.unionByName(smaller.withColumnRenamed("m", "v")).distinct(), "links")
    roots = edges.select(F.col("v").alias("id")).distinct().withColumn("root", F.col("id"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(roots)


def _settled(edges: DataFrame) -> bool:
    """Whether each id has one link down, to an id that has none."""
    down = edges.groupBy("u").agg(F.count("*").alias("n"))
    open_ids = edges.join(down.select(F.col("u").alias("v")), "v", "left_semi").select("u").unionByName(down.where("n > 1").select("u"))
    return open_ids.isEmpty()
