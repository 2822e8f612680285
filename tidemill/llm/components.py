"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import dropped, stored


def components(links: DataFrame) -> DataFrame:
    """``(a, b)`` links of non-null ids -> stored ``(node, root)``: root is the smallest id reachable.

    Nodes without a link to another node are absent. Every round hangs the neighbours of a node on its smallest
    neighbour, larger ones first, then the rest; the number of rounds grows with the logarithm of the longest chain.
    Rounds end when every node has one smaller neighbour and no larger one, or no smaller one; then the smallest
    neighbours are the roots. They are stored before they are joined, so a node with very many links is a skewed join
    that adaptive execution splits, not a group.
    """
    up = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        both = up.union(up.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(
            both.groupBy("u").agg(
                F.least(F.min("v"), F.col("u")).alias("m"), F.count_if(F.col("v") < F.col("u")).alias("below"),
                F.count_if(F.col("v") > F.col("u")).alias("above"),
            ), "low",
        )
        if low.where("below > 1 OR (below = 1 AND above > 0)").isEmpty():
            dropped(up)
            return low.select(F.col("u").alias("node"), F.col("m").alias("root"))
        large = both.join(low.select("u", "m"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        star = stored(large.where("u <> v").distinct(), "star")
        dropped(low)
        low = stored(star.groupBy("u").agg(F.min("v").alias("m")), "low")
        met = star.join(low, "u")
        small = met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v"))
        )
        after = stored(small.distinct(), "links")
        for old in (up, star, low):
            dropped(old)
        up = after
