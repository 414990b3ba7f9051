"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kickwx.llm.scratch import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = written(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "large-star")
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = written(down.groupBy("a").agg(F.min("b").alias("m")), "small-star")
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``a, b`` (long) edges to ``node, root`` rows: every node on an edge, with the smallest node it reaches.

    Each round writes its edges; their number never grows beyond the first round's. Minima are combined before
    they are shuffled and written, so that the skew join can split the rows of a hub. Loops and repeated or null-ended
    edges are dropped; without edges there are no rows.
    """
    now = written(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    mark = None
    while True:
        seen = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if not seen[0] or seen == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        mark = seen
        now = written(_small_star(written(_large_star(now).distinct(), "edges")).distinct(), "edges")
