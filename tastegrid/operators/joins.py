"""Equi-joins on an item or user key.

No join here carries a broadcast hint.  Spark broadcasts a side only when its
size is known to be under ``spark.sql.autoBroadcastJoinThreshold``; beyond it
the join shuffles.  Adaptive execution splits hot keys of either side of an inner
join, and of the left side of a left join; ``left_join_events`` is for a left join
whose right side is hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join(left: DataFrame, *others: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left joins one after the other."""
    for other in others:
        left = left.join(other, on, "left")
    return left


def left_join_events(left: DataFrame, events: DataFrame, on: str) -> DataFrame:
    """Left join with many events per key: an inner join, which splits hot keys, and the keys without events."""
    rest = [c for c in events.columns if c != on]
    matched = left.join(events, on)
    alone = left.join(events.select(on).distinct(), on, "left_anti")
    kinds = dict(events.dtypes)
    empty = alone.select("*", *[F.lit(None).cast(kinds[c]).alias(c) for c in rest])
    return matched.unionByName(empty)


def inner_join(left: DataFrame, *others: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Inner joins one after the other."""
    for other in others:
        left = left.join(other, on, "inner")
    return left


def keep_matching(frame: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    names = [on] if isinstance(on, str) else list(on)
    return frame.join(keys.select(*names), names, "left_semi")


def drop_matching(frame: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``keys``."""
    names = [on] if isinstance(on, str) else list(on)
    return frame.join(keys.select(*names), names, "left_anti")


def with_group_size(frame: DataFrame, events: DataFrame, on: str, name: str = "count") -> DataFrame:
    """Inner join with the number of ``events`` per key, counted before the shuffle."""
    sizes = events.groupBy(on).agg(F.count(F.lit(1)).alias(name))
    return frame.join(sizes, on, "inner")


def most_active(events: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` keys with most rows, ties by key: a distributed top-n, not a full sort."""
    return (events.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(key)).limit(n))


def keep_most_active(events: DataFrame, key: str, n: int) -> DataFrame:
    """Rows of the ``n`` most active keys."""
    return keep_matching(events, most_active(events, key, n), key)
