"""Connected components of a graph whose links are a table: alternating large and small stars.

Every round is joins and aggregates over the links, written to the shared folder; nothing is
collected but two numbers that tell whether a round changed anything.  The least neighbours are
written before they are joined, so that the join is one whose hot nodes Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.sources.settled import scratch, settle


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked to the least of the node and its neighbours."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = settle(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    return both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the least of these."""
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = settle(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    others = down.join(least, "u").where("v > m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """node and component (the least node reachable) of every node that has a link; links: a, b."""
    now, before = settle(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"), None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        with scratch() as kept:
            now = settle(_small_star(_large_star(now)).where("a <> b").distinct(), "links")
            kept.append(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
