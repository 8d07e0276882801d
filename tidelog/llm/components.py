"""Connected components of an edge table, without ever holding a component in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.scratch import cut


def _smallest(pairs: DataFrame) -> DataFrame:
    """``(u, v, m)`` where m is the smallest of u and all its v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (u, v)``; root is the smallest node.

    Alternating large-star and small-star steps: every step keeps the components, shortens
    paths and needs one aggregate and one join. The edges of each round are written to the
    shared folder, and rounds end when nothing changes. Loops and repeats do no harm; no
    edges give no rows.
    """
    now = cut(edges.select("u", "v").filter("u <> v").distinct())
    mark = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = _smallest(down)
        small = least.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        now = cut(small.filter("u <> v").distinct())
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if seen == mark:
            break
        mark = seen
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("v", "v"))
