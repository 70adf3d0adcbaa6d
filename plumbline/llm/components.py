"""Connected components by alternating large-star and small-star steps.

Links are (a, b) pairs of long ids. A large-star step joins every larger neighbour of a node
to the smallest neighbour, a small-star step every smaller one. Once nothing changes each
component is a star around its smallest id. Neighbours are never collected: a step is an
aggregate for the minimum and a salted join, so a node linked with everything is many parts.
Each step is a table in the shared folder; only two numbers per step reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import durable, forget, hot_join


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return hot_join(both.where("b > a"), least, ["a"], [F.col("b")]).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = hot_join(down, least, ["a"], [F.col("b")]).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(a, b) per linked id a that is not the smallest of its component: b is the smallest."""
    now = durable(links.where("a <> b").select("a", "b").distinct())
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if not mark[0] or tuple(mark) == seen:
            return now
        seen = tuple(mark)
        large = durable(_large_star(now).where("a <> b").distinct())
        after = durable(_small_star(large).where("a <> b").distinct())
        forget(now, large)
        now = after
