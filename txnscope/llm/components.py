"""Connected components by alternating large-star and small-star steps.

Labels are the smallest node of each component.  Each round is two shuffles over the
remaining links and is written to the shared checkpoint folder, so a lost executor
costs one round; the number of rounds grows with the logarithm of the longest path.
A node with very many links is pre-aggregated: only its minimum is needed in a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscope.plans.frames import materialize


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m"))


def connected(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b)."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    before = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        small_least = _least(large)
        pairs = large.join(small_least, "u")
        edges = materialize(pairs.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
                            .where("u != v").distinct(), "components")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots)
