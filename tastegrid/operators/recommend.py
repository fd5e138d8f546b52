"""The best unseen items of given users (RC10-RC12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.operators.ranking import top_k_per_group


def top_unseen(ranked: DataFrame, users: DataFrame, seen: DataFrame, group: str, user: str, item: str,
               k: int = 5) -> DataFrame:
    """(user, pos, item): each user's first ``k`` items they have not seen.

    ``ranked`` is a ranking per group, ``users`` holds (user, group).  A user
    reads the first ``k`` plus as many items as they have seen, which always
    holds their answer; users and items are never multiplied out.
    """
    seen = seen.select(user, item).distinct()
    asked = users.select(user, group).distinct()
    counts = seen.groupBy(user).agg(F.count(F.lit(1)).alias("_seen"))
    need = asked.join(counts, user, "left").withColumn("_need", F.coalesce("_seen", F.lit(0)) + k)
    # ranks beyond the largest need serve nobody
    deepest = need.agg(F.max("_need").alias("m")).scalar()
    listed = (ranked.where(F.col("rank") <= deepest).join(need, group).where("rank <= _need")
              .select(user, item, "rank"))
    fresh = listed.join(seen, [user, item], "left_anti")
    return top_k_per_group(fresh, user, [F.asc("rank")], k).select(user, "pos", item)
