"""Connected components of a link table by alternating star steps, all in Spark.

Every step turns each node's links towards its smallest neighbour; the links end as stars
around the smallest node of each component.  A row at most reaches the driver, and each round is cut from its lineage by a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter("v > u").join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    turned = links.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return turned.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _are_stars(links: DataFrame) -> bool:
    """Whether every node has one link downward and no center has one."""
    twice = links.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    inner = links.join(links.select(F.col("v").alias("u")).distinct(), "u", "left_semi")
    return not twice.take(1) and not inner.take(1)


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (u, v); component is the smallest node reachable.

    Null ends and links of a node with itself are left out.
    """
    now = stored(links.filter("u is not null and v is not null and u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    while not _are_stars(now):
        now = stored(_small_star(_large_star(now).distinct()), "links")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
