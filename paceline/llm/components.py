"""Connected components of a graph held as links, by alternating stars.

Each round first hangs the larger neighbours of a node on the smallest one, then the smaller ones. Both
steps are an aggregation to one number per node and a join back, so a node with very many links is
summed before the shuffle and its rows may be split in the join; no node's links are ever gathered.
Links at rest are stars around the smallest node of their component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.llm.tables import stored


def _large(links: DataFrame) -> DataFrame:
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least.select(F.col("a").alias("k"), "m"), F.col("a") == F.col("k")).filter("b <> m").select(
        F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long); the root is the smallest node reachable.

    Links of a node with itself and repeated links are allowed; nodes without links to others are left out.
    """
    now = stored(links.select("a", "b").filter("a <> b").distinct(), "links")
    state = None
    while True:
        was, state = state, tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == was or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        now = stored(_small(_large(now)).filter("a <> b").distinct(), "stars")
