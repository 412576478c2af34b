"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``: the smallest node reachable.

    Alternates two steps until nothing changes: every node hangs its larger neighbours,
    then its smaller ones, on the smallest node it knows. Both keep what is connected and
    shorten paths, so that the number of rounds follows the logarithm of the size. Links
    stay in tables throughout; only how many have changed is looked at.
    """
    pairs = links.filter(F.col("a") != F.col("b"))
    edges = stored(
        pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    last = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.filter(F.col("v") > F.col("u"))
            .join(least, "u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .distinct()
        )
        large = stored(large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = (
            small.filter(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = stored(small, "edges")
        # Once every node hangs on its root directly, a round changes nothing.
        state = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == last:
            break
        last = state
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return leaves.unionByName(roots)
