"""Connected components by alternating large and small stars, all on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratalake.sources import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node it is linked to) for every end of an edge (``u``, ``v``).

    A large star ties every larger neighbour to a node's smallest neighbour, a
    small star does so for smaller neighbours and the node itself; repeated, each
    component becomes one star around its smallest node, in a number of rounds
    that grows with the logarithm of its size. Each round is written, so a lost
    executor costs no earlier round, and only its count and checksum come back.
    """
    now = stage(
        edges.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(),
        "components",
    )
    seen = None
    while True:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(lowest, "u").filter("v > u").select(F.col("m").alias("u"), "v").filter("u <> v").distinct()
        large = stage(large, "large-star")
        lowest = large.groupBy("v").agg(F.min("u").alias("m"))
        tied = large.join(lowest, "v")
        small = tied.select(F.least("u", "m").alias("a"), F.greatest("u", "m").alias("b")).union(
            lowest.select(F.col("m").alias("a"), F.col("v").alias("b"))
        )
        now = stage(small.filter("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), "small-star")
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            break
        seen = state
    roots = now.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    return now.select(F.col("v").alias("node"), F.col("u").alias("root")).union(roots)
