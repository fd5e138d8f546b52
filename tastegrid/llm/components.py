"""Connected components of a link table by repeated star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.tables import written


def digest(edges: DataFrame) -> tuple:
    """Count and two sums of hashes of the rows, the same for equal tables only."""
    u, v = F.col("u"), F.col("v")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64(u, v).cast("decimal(20)")),
                           F.sum(F.xxhash64(v, u, F.lit(1)).cast("decimal(20)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id reachable from every linked id.

    Each round first ties an id's larger neighbours, then its smaller ones, to
    the smallest of them.  Groups are reduced before the shuffle and every round
    is a written table, so lost executors cost one round at most.  Ids without a
    link have no row; null ids and links to oneself are left out.
    """
    edges = written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                    .where("u > v").distinct(), "edges")
    last = digest(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(least, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = (joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).where("u > v").distinct())
        small = written(small, "edges")
        now = digest(small)
        if now == last:
            break
        edges, last = small, now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
