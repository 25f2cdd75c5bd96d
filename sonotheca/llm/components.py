"""Connected components over an edge table, as Spark joins with checkpointed rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonotheca.session import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``root`` for every node of an edge table; ``root`` is the smallest node reached.

    Alternates two star steps until nothing changes: every node hands the smallest of
    its neighbours to its larger neighbours, then to its smaller ones.  Each round is a
    table in the shared folder, so the lineage stays short and survives lost executors.
    The number of rounds grows with the logarithm of the longest chain.  Minima are
    combined before the shuffle; the joins read plain tables, so Spark may split a node
    that has very many neighbours.
    """
    now = written(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "edges")
    state = None
    while True:
        both = written(now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both")
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = written(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .where("u <> v").distinct(), "large")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        # the sum and count of an order-free digest tell whether a round changed anything
        digest = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if digest == state:
            break
        state = digest
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
