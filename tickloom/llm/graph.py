"""Connected components by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.session import stored


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """`node`, `component` for each node of an edge: the smallest node that it reaches.

    Each round joins nothing: nodes are grouped with their neighbours' minimum only, and rows move
    to that minimum. Hot nodes combine before the shuffle. A round's rows are written to the shared
    folder, which cuts the lineage; the number of rounds grows with the logarithm of the diameter.
    """
    pairs = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u <> v")
    pairs = stored(_larger_first(pairs).distinct(), "components")
    while True:
        # Large star: every larger neighbour of u moves to the least node around u.
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = _larger_first(large.filter("u <> v")).distinct()
        # Small star: u and its smaller neighbours move to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v")
        after = stored(_larger_first(small).distinct(), "components")
        moved = after.join(pairs, ["u", "v"], "left_anti").limit(1).count()
        if not moved and after.count() == pairs.count():
            break
        pairs = after
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _larger_first(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
