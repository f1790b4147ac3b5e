"""Connected components by alternating large-star and small-star steps.

Each step is one aggregation (combined before the shuffle, so a hub is harmless) and one
join, which adaptive execution splits at a hub.  Every round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rowloom.session import forget, written


def components(edges: DataFrame) -> DataFrame:
    """``edges`` of u, v (any orderable type) to v, root: root is the least node reachable.

    Nodes without an edge, and the roots themselves, have no row.
    """
    edges = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select("u", F.col("m").alias("v")).union(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        before_edges, edges = edges, written(small.distinct(), "small-star")
        forget(before_edges, large)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("v"), F.col("v").alias("root"))
        before = state
