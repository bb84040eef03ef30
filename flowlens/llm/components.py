"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import materialize


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them; every link has a > b."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(a, root): the smallest node of its component for every linked node but the smallest itself.

    ``links`` has columns a and b of one ordered type, without NULL; self links and repeats do not matter.
    Every round is written to the shared folder, so its lineage does not grow; rounds grow with the logarithm
    of the nodes. No step gathers the neighbours of a node in one place.
    """
    now = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .distinct(), "links")
    state = None
    while True:
        fresh = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if fresh == state or fresh[0] == 0:
            return now.select("a", F.col("b").alias("root"))
        state = fresh
        now = materialize(_small_star(_large_star(now)), "links")
