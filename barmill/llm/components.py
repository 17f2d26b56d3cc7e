"""Connected components of links kept as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barmill.llm.util import stored

ROUNDS = 50


def components(links: DataFrame) -> DataFrame:
    """node and component (the least node reachable) of every node of links (a, b).

    Large and small stars in turn: every node's larger neighbours, then its smaller ones and itself, are tied to its least
    neighbour, until nothing changes. Only a checksum of the links comes to the driver.
    """
    links = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    for _ in range(ROUNDS):
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        links = stored(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "small")
        now = links.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    members = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.union(links.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
