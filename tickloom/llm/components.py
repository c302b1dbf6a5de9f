"""Connected components of a large graph by alternating stars (Kiveris et al., 2014).

Every round is two grouped minima and two equi-joins on the edge table; nothing but two numbers
reaches the driver. A node with many neighbours is met by map-side minima and skew-split joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import stage, unstage


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root) for every node that has an edge; root is the smallest node it reaches.

    Loops and null ends are ignored; repeated edges count once. Without edges the result is empty.
    """
    a, b = F.col(u), F.col(v)
    now = stage(edges.where(a != b).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "edges")
    before = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if seen == before or not seen[0]:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
                now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
            )
        before = seen
        both = now.select(F.col("hi").alias("x"), F.col("lo").alias("y")).union(now.select(F.col("lo").alias("x"), F.col("hi").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.join(least, "x").where("y > x").select(F.col("y").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        after = stage(small.union(least.select("hi", F.col("m").alias("lo"))).distinct(), "edges")
        unstage(now)
        now = after
