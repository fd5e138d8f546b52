"""Repeatable samples, splits and stratified panels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.functions import hashing
from tastegrid.operators.ranking import rank_in_group


def key_of(*columns: str) -> Column:
    """One text key of several columns; a null is marked, so its place counts."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns])


def thin(frame: DataFrame, key: Column, share: float = 0.5, seed: int = 42) -> DataFrame:
    """Keep each row with probability ``share``, decided by its key."""
    return frame.where(hashing.drawn_below(hashing.draw(key, seed), share))


def split(frame: DataFrame, key: Column, test_share: float, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test): disjoint, together everything, the same on every run; a null key is for training."""
    chosen = F.coalesce(hashing.drawn_below(hashing.draw(key, seed), test_share), F.lit(False))
    return frame.where(~chosen), frame.where(chosen)


def with_split(frame: DataFrame, key: Column, test_share: float, seed: int = 42,
               name: str = "is_test") -> DataFrame:
    """The split as a flag, when both sides are used in one plan."""
    chosen = hashing.drawn_below(hashing.draw(key, seed), test_share)
    return frame.withColumn(name, F.coalesce(chosen, F.lit(False)))  # as in ``split``


def with_fold(frame: DataFrame, key: Column, k: int = 5, seed: int = 42) -> DataFrame:
    """Add ``fold`` 0..k-1."""
    return frame.withColumn("fold", hashing.fold(hashing.draw(key, seed), k))


def training_folds(frame: DataFrame, k: int = 5) -> DataFrame:
    """Each row once for every fold it trains, i.e. every fold but its own."""
    others = F.array_except(F.sequence(F.lit(0), F.lit(k - 1)), F.array("fold"))
    return frame.withColumn("fold", F.explode(others))


def random_keys(frame: DataFrame, key: str, n: int = 3, seed: int = 42) -> DataFrame:
    """``n`` distinct keys in hash order."""
    return (frame.select(key).distinct()
            .orderBy(hashing.draw(F.col(key), seed), F.asc(key)).limit(n))


def ranked_in_stratum(frame: DataFrame, stratum: str, key: str, seed: int = 42,
                      digits: int = 3) -> DataFrame:
    """Add ``rank``, the row's place in its stratum's hash order.

    The first ``digits`` hex digits split each stratum into 16**digits parts
    that are sorted apart; a stratum holding most rows stays spread out.
    """
    hashed = frame.withColumn("_hash", hashing.draw(F.col(key), seed))
    ranked = rank_in_group(hashed, [stratum], F.substr("_hash", F.lit(1), F.lit(digits)),
                           [F.asc("_hash"), F.asc(key)])
    return ranked.drop("_hash")


def _quota_of(stratum: Column, quotas: Mapping[str, int]) -> Column:
    pairs = [F.lit(x) for item in quotas.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), stratum), F.lit(0))


def quota_sample(frame: DataFrame, stratum: str, key: str, quotas: Mapping[str, int],
                 seed: int = 42) -> DataFrame:
    """min(group size, quota) rows of each stratum."""
    ranked = ranked_in_stratum(frame, stratum, key, seed)
    return ranked.where(F.col("rank") <= _quota_of(F.col(stratum), quotas)).drop("rank")


def stratified_panel(frame: DataFrame, stratum: str, key: str, quotas: Mapping[str, int],
                     total: int, seed: int = 42) -> DataFrame:
    """The quota draw, then the free places shared out in proportion to what is left.

    Adds ``source`` (quota or extra).  Shares are rounded down, so the panel
    has ``total`` rows or a few less.  Both draws follow one hash order, hence
    one ranking pass serves both.
    """
    sized = (frame.where(F.col(stratum).isNotNull()).groupBy(stratum)
             .agg(F.count(F.lit(1)).alias("_size"))
             .withColumn("_quota", F.least(F.col("_size"), _quota_of(F.col(stratum), quotas).cast("bigint"))))
    sums = sized.agg(F.struct(F.sum("_quota").alias("taken"),
                              F.sum(F.col("_size") - F.col("_quota")).alias("left"))).scalar()
    slots = F.greatest(F.lit(total) - sums["taken"], F.lit(0))
    rest = F.col("_size") - F.col("_quota")
    extra = F.coalesce(F.floor(F.try_divide(slots * rest, sums["left"])), F.lit(0))
    limits = sized.select(stratum, "_quota", F.least(rest, extra).alias("_extra"))
    ranked = ranked_in_stratum(frame.where(F.col(stratum).isNotNull()), stratum, key, seed)
    return (ranked.join(limits, stratum)
            .where(F.col("rank") <= F.col("_quota") + F.col("_extra"))
            .withColumn("source", F.when(F.col("rank") <= F.col("_quota"), "quota").otherwise("extra"))
            .drop("rank", "_quota", "_extra"))
