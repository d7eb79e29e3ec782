"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the least of its neighbours and itself."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the least of these."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of each node of ``links`` (a, b) but the least of its component, which names it.

    Links may repeat and run either way; links to oneself and null ends count for
    nothing. Each round is written to the shared folder. A hub takes part in joins
    as one row on one side, so its links can be split over tasks.
    """
    links = links.where("a is not null and b is not null and a <> b")
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links, before = stored(links, "links"), None
    while True:
        digest = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if digest[0] == 0 or digest == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = digest
        links = stored(_small_star(_large_star(links)).distinct(), "links")
