"""Connected components of a sparse graph by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflens.operators.keep import keep


def stars(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) as stars: one row (node, root) for each node but the roots.

    The root of a component is its smallest node. Each round links every node's larger
    neighbours, then its smaller ones, to the least node it knows; the number of rounds grows
    with the logarithm of a component's size. Edges stay on the executors, each round's are
    written to the shared checkpoint folder.
    """
    now = keep(
        edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    state = None
    while True:
        seen = now.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state or not seen[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = seen
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("least"))
        large = (
            both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.least("u", "least").alias("v"))
        ).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("least"))
        small = (
            large.join(least, "u")
            .select(F.when(F.col("v") == F.col("least"), F.col("u")).otherwise(F.col("v")).alias("u"), "least")
            .union(least.select("u", "least"))
            .withColumnRenamed("least", "v")
            .distinct()
        )
        now = keep(small)
