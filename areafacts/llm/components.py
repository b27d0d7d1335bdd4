"""Connected components of a link table by alternating large-star and small-star steps.

Every step is a grouped minimum (pre-aggregated in the tasks) and an equi-join back to the links, written to the shared
folder, so the number of steps grows with the logarithm of a component's diameter, and nothing but two numbers reaches
the driver. A hub's links are one skewed key of a join, which the adaptive planner splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areafacts.llm.common import stored


def _signature(links: DataFrame):
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link: ``root`` is the smallest node it reaches. ``links``: (a, b)."""
    links = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = _signature(links)
    while True:
        links = stored(_small_star(_large_star(links).distinct()).distinct(), "links")
        now = _signature(links)
        if now == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
