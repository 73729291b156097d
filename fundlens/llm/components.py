"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.llm.common import materialise


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    return (e.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, component): least node reachable, for every node that has a link.

    ``links`` has two id columns a and b; self-links, repeats and nulls are ignored.
    The link table is contracted to stars towards the least ids until it no longer
    changes; each round is written to the shared scratch folder, and only its row count
    and checksum reach the driver.
    """
    e = materialise(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "links")
    state = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or now[0] == 0:
            break
        state = now
        e = materialise(_small_star(_large_star(e)), "links")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
