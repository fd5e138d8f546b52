"""Errors of predicted ratings and quality of rankings (EV).

A ranking is a table (group, item, rank, n): ``rank`` 1 is the best of the ``n``
items scored for the group.  A group is a user, or whatever users share their
scores, so users who share a ranking never multiply it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tastegrid.operators.ranking import rank_in_group


def rmse(actual: str = "rating", predicted: str = "prediction") -> Column:
    """Root of the mean squared error; rows with a null on either side are left out."""
    gap = F.col(actual) - F.col(predicted)
    return F.sqrt(F.avg(gap * gap))


def mae(actual: str = "rating", predicted: str = "prediction") -> Column:
    """Mean absolute error; rows with a null on either side are left out."""
    return F.avg(F.abs(F.col(actual) - F.col(predicted)))


def ranking(scores: DataFrame, group: str, item: str, score: str, bucket: Column | None = None) -> DataFrame:
    """(group, item, rank, n) of a score table, best first, ties by item.

    ``bucket`` must not fall along that order; it spreads a large group over
    tasks.  By default it comes from rows drawn by hash: each drawn (score, item)
    is a cut, so fractional scores and long runs of one score are spread as well.
    """
    known = scores.where(F.col(group).isNotNull() & F.col(item).isNotNull() & F.col(score).isNotNull())
    placed = rank_in_group(known, [group], score_cuts(known, item, score) if bucket is None else bucket,
                           [F.desc(score), F.asc(item)])
    sizes = known.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    return placed.join(sizes, group).select(group, item, "rank", "n")


def score_cuts(scores: DataFrame, item: str, score: str, cuts: int = 64) -> Column:
    """Which of at most ``cuts`` stretches of the order (score falling, item rising) a row lies in."""
    drawn = (scores.select(item, score).distinct().orderBy(F.xxhash64(item, score), item, score).limit(cuts * 16).collect())
    ordered = sorted(drawn, key=lambda r: r[0])
    ordered.sort(key=lambda r: -r[1])
    edges = ordered[16::16]
    kinds = dict(scores.dtypes)
    lists = [F.array(*[F.lit(e[i]) for e in edges]).cast(f"array<{kinds[c]}>") for i, c in enumerate((item, score))]
    passed = F.zip_with(lists[0], lists[1], lambda i, s: (s > F.col(score)) | ((s == F.col(score)) & (i < F.col(item))))
    return F.size(F.filter(passed, lambda p: p))


def ranks_of(ranked: DataFrame, test: DataFrame, group: str, user: str, item: str,
               seen: DataFrame | None = None) -> DataFrame:
    """(user, item, rank, n) of every test pair; rank and n are null where the item has no score.

    ``test`` and ``seen`` hold (user, group, item).  With ``seen``, those items
    are taken out of each user's ranking; by default they stay in.
    """
    rows = test.select(user, group, item).distinct().withColumn("_seen", F.lit(0))
    if seen is not None:
        rows = rows.unionByName(seen.select(user, group, item).distinct().join(
            rows.select(user, item), [user, item], "left_anti").withColumn("_seen", F.lit(1)))
    rows = rows.join(ranked, [group, item], "left")
    if seen is not None:  # windows over a user's own rows, not over all items
        before = W.partitionBy(user).orderBy(F.asc_nulls_last("rank"))
        gone = F.sum(F.when(F.col("rank").isNotNull(), F.col("_seen")).otherwise(0))
        rows = (rows.withColumn("_all", gone.over(W.partitionBy(user))).withColumn("_above", gone.over(before))
                .withColumn("rank", F.col("rank") - F.col("_above")).withColumn("n", F.col("n") - F.col("_all")))
    return rows.where("_seen = 0").select(user, item, "rank", "n")


def precision_at_k(ranks: DataFrame, user: str, k: int = 10) -> DataFrame:
    """(user, precision): test items among the first ``k``, divided by ``k``."""
    hit = F.coalesce((F.col("rank") <= k).cast("int"), F.lit(0))
    return ranks.groupBy(user).agg((F.sum(hit) / F.lit(float(k))).alias("precision"))


def auc(ranks: DataFrame, user: str) -> DataFrame:
    """(user, auc): chance that a test item stands above another item, by rank sums.

    Test items without a score take no part; users without a test item or
    without another item are left out.
    """
    up = F.col("n") - F.col("rank") + 1
    sums = ranks.where("rank is not null").groupBy(user).agg(
        F.sum(up).alias("s"), F.count(F.lit(1)).alias("p"), F.max("n").alias("n"))
    # twice the pair count is whole, so the only division is the last one
    pairs = (F.col("s") * 2 - F.col("p") * (F.col("p") + 1)).cast("double")
    return sums.where("n > p").select(user, (pairs / (F.col("p") * (F.col("n") - F.col("p")) * 2)).alias("auc"))


def classification_report(frame: DataFrame, actual: str, predicted: str) -> DataFrame:
    """label, precision, recall, f1, support of every label; one pass and a few rows after it."""
    pairs = frame.groupBy(actual, predicted).agg(F.count(F.lit(1)).alias("c"))
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col(actual).alias("label"), F.lit(1).alias("real"), F.lit(0).alias("said"), "c",
                 (F.col(actual) == F.col(predicted)).cast("int").alias("hit")),
        F.struct(F.col(predicted).alias("label"), F.lit(0).alias("real"), F.lit(1).alias("said"), "c",
                 F.lit(0).alias("hit")))).alias("x")).select("x.*").where("label is not null")
    total = lambda name: F.sum(F.col(name) * F.col("c"))
    sums = sides.groupBy("label").agg(total("hit").alias("hits"), total("real").alias("support"),
                                      total("said").alias("said"))
    share = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    hits, support, said = F.col("hits"), F.col("support"), F.col("said")
    return sums.select("label", share(hits, said).alias("precision"), share(hits, support).alias("recall"),
                       share(hits * 2, support + said).alias("f1"), "support")
