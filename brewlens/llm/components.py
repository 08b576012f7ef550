"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brewlens.llm.common import written


def _joined_min(pairs: DataFrame) -> DataFrame:
    """(u, v, low): low is the least of u and its neighbours.  The minimum is folded
    before the shuffle and joined back from a written table, so that a hub's rows can be split."""
    low = written(pairs.groupBy("u").agg(F.min("v").alias("low")).select(
        F.col("u").alias("w"), F.least("u", "low").alias("low")), "cc-low")
    return pairs.join(low, pairs["u"] == low["w"]).select("u", "v", "low")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the component's least node.

    Ends when every node points straight at a root; there is no round limit.
    """
    edges = edges.select("a", "b").filter("a != b")
    stars = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc-edges")
    while True:
        # a node that is above one and below another, or above two: counted on both ends of every edge, in one job
        ends = stars.select(F.col("u").alias("x"), F.lit(1).alias("above"), F.lit(0).alias("below")).unionByName(
            stars.select(F.col("v").alias("x"), F.lit(0).alias("above"), F.lit(1).alias("below")))
        seen = ends.groupBy("x").agg(F.sum("above").alias("above"), F.sum("below").alias("below"))
        if not seen.filter("above > 1 OR (above > 0 AND below > 0)").limit(1).count():
            break
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = written(_joined_min(both).filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
                        .filter("u != v").distinct(), "cc-large")
        small = _joined_min(large)
        stars = written(small.select(F.col("v").alias("u"), F.col("low").alias("v"))
                        .unionByName(small.select("u", F.col("low").alias("v"))).filter("u != v").distinct(), "cc-small")
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
