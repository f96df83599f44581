"""Connected components of links, by alternating large-star and small-star steps.

Each step is one grouped minimum and one join; the links are written after
each round, so no plan grows with the rounds and a lost executor costs one
round.  Nothing but two numbers reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wiremap.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Each larger neighbour of u is linked to the smallest of u and its neighbours."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    # Repeated links are left to the small star, which drops them in its own shuffle.
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """u and its smaller neighbours are linked to the smallest of them (here v < u)."""
    low = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows (id, component) for every id of ``links`` (a, b); component: smallest id.

    Self links and repeated links change nothing; no links give no rows.
    """
    now = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .distinct(), "links")
    before = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
        now = stored(_small_star(_large_star(now)), "links")
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
