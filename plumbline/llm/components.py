"""Connected components of an edge list, as alternating star contractions on DataFrames.

Every round is written to the shared folder, so that lineage stays short and lost executors cost one round at most.
Nothing but two checksums of a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import forget, stored


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) of every node that is not its component's least node. edges: (a, b), in any order, with repeats.

    An edge from a node to itself adds nothing; nodes are longs; without edges the result is empty.
    """
    e = edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = stored(spark, e, "edges")
    seen = _mark(e)
    while seen[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
        large = both.join(least, both.u == least.n).filter("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("k")).withColumnRenamed("u", "n")
        small = large.join(least.filter("k > 1"), large.u == F.col("n")).filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, e = e, stored(spark, least.select(F.col("n").alias("u"), F.col("m").alias("v")).union(small).distinct(), "edges")
        forget(last)
        now = _mark(e)
        if now == seen:
            break
        seen = now
    out = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    out.stored_at = e.stored_at
    return out
