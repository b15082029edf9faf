"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import dropped, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the least id of the node's component; roots themselves and nodes without edges are left out.

    edges: columns a and b; loops and repeated edges don't matter, null ends are dropped. Every step's edges are stored,
    so that an executor's loss costs one step at most. The number of steps grows with the logarithm of the longest path.
    """
    e = stored(edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    while True:
        # Least neighbours by partial aggregation and a join: the row of a root that a third of all nodes hang on is no hot one.
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        small = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.u", "x.v")
        before, e = e, stored(small.where("u <> v").distinct())
        dropped(before)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
