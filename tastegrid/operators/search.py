"""All settings of a neighbourhood model, cross-validated in one job (EV6).

The ratings meet themselves once per side, in the buckets of ``neighbours.with_raters``.
Every co-rating adds to the sums of the folds in which both its ratings train, so one
pass over a bucket gives the similarities of all kinds and folds; these rank the
neighbours of every rating of the bucket once per kind, and each k is a sum over the
first k ranks.  Only sums of errors by setting and fold leave a bucket.  For an ``a``
that is cut into parts the nearest of each part do, which are ranked again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.functions.ratings import SCALE_HIGH, SCALE_LOW, clip_rating
from tastegrid.operators.neighbours import Pairs, likeness, ranked, with_raters
from tastegrid.operators.ranking import top_k_per_group


ERRORS = "kind int, k int, fold int, n long, squares double, gaps double"


def likeness_of_folds(pairs: Pairs, kinds: Sequence[str], folds: int) -> np.ndarray:
    """(kind, pair): the likeness of a rating's owner and another rater, from the folds that the rating is not in."""
    x, fa, y, fb = pairs.of_row("x"), pairs.of_row("fa"), pairs.of_list("y"), pairs.of_list("fb")
    sims = np.full((len(kinds), len(pairs.row)), np.nan)
    for f in range(folds):
        sums = pairs.sums(x, y, np.flatnonzero((fa != f) & (fb != f)))
        held = np.flatnonzero((fa == f) & (fb != f))
        for i, kind in enumerate(kinds):
            sims[i, held] = likeness(kind, sums)[pairs.key[held]]
    return sims


def errors_of_folds(kinds: Sequence[str], ks: Sequence[int], folds: int, base: dict[int, float],
                    opened: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """Sums of the errors of all ratings of a bucket; a rating without neighbours gets the ``base`` of its fold."""
    at_fold = np.array(sorted(base), dtype=np.int64)
    of_fold = np.array([base[f] for f in at_fold.tolist()], dtype=np.float64)

    def work(table: pa.Table) -> pa.Table:
        table = opened(table)
        pairs = Pairs(table)
        y, sims = pairs.of_list("y"), likeness_of_folds(pairs, kinds, folds)
        over, names = ranked(table["over"].combine_chunks())
        # the raters of one thing may come in several lists
        ratings = pairs.of * max(1, len(names)) + over
        keys, first, rating = np.unique(ratings, return_index=True, return_inverse=True)
        actual = table["rating"].to_numpy()[first]
        fold = np.searchsorted(at_fold, table["fa"].to_numpy()[first])
        out = []
        for i in range(len(kinds)):
            at = np.flatnonzero(sims[i] > 0)
            group, sim, value = rating[pairs.row[at]], sims[i][at], y[at]
            for k in ks:
                keep, _ = pairs.first(group, sim, pairs.b[at], k)
                top, bottom = (np.bincount(group[keep], w, len(keys)) for w in (sim[keep] * value[keep], sim[keep]))
                with np.errstate(divide="ignore", invalid="ignore"):
                    drawn = np.where(bottom > 0, top / bottom, of_fold[fold])
                gap = actual - np.clip(drawn, SCALE_LOW, SCALE_HIGH)
                known = ~np.isnan(gap)
                n, squares, gaps = (np.bincount(fold[known], w, len(at_fold)) for w in (
                    np.ones(known.sum()), gap[known] ** 2, np.abs(gap[known])))
                here = np.flatnonzero(np.bincount(fold, minlength=len(at_fold)))
                out.append(pa.table([pa.array(np.full(len(here), v, dtype=np.int32)) for v in (i, k)]
                                    + [pa.array(at_fold[here].astype(np.int32)), pa.array(n[here].astype(np.int64)),
                                       pa.array(squares[here]), pa.array(gaps[here])],
                                    names=["kind", "k", "fold", "n", "squares", "gaps"]))
        return pa.concat_tables(out)
    return work


def nearest_of_folds(kinds: Sequence[str], most: int, folds: int,
                     opened: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """(a, over, kind, b, sim, y): the first ``most`` neighbours of the ratings of a bucket, from the folds that a rating is not in."""
    def work(table: pa.Table) -> pa.Table:
        table = opened(table)
        pairs = Pairs(table)
        y, sims = pairs.of_list("y"), likeness_of_folds(pairs, kinds, folds)
        over, names = ranked(table["over"].combine_chunks())
        out = []
        for i in range(len(kinds)):
            at = np.flatnonzero(sims[i] > 0)
            _, group = np.unique(pairs.a[at] * max(1, len(names)) + over[pairs.row[at]], return_inverse=True)
            at = at[pairs.first(group, sims[i][at], pairs.b[at], most)[0]]
            out.append(pa.table([pairs.names.take(pa.array(pairs.a[at])), names.take(pa.array(over[pairs.row[at]])),
                                 pa.array(np.full(len(at), i, dtype=np.int32)), pairs.names.take(pa.array(pairs.b[at])),
                                 pa.array(sims[i][at]), pa.array(y[at])], names=["a", "over", "kind", "b", "sim", "y"]))
        return pa.concat_tables(out)
    return work


def side_errors(ratings: DataFrame, user_based: bool, kinds: Sequence[str], ks: Sequence[int], folds: int,
                base: DataFrame) -> DataFrame:
    """(kind, k, fold, n, squares, gaps): sums of errors of the ratings, predicted from the folds they are not in.

    ``base`` is (fold, _base), what a rating without neighbours gets.
    """
    of, over = ("user_id", "item_id") if user_based else ("item_id", "user_id")
    value = F.col("rating").cast("double")
    own = ratings.select(F.col(over).alias("over"), F.col(of).alias("a"), value.alias("x"), value.alias("rating"), F.col("fold").alias("fa"))
    met = with_raters(own, ratings.select(F.col(over).alias("over"), F.col(of).alias("b"), value.alias("y"), F.col("fold").alias("fb")))
    of_folds = {r["fold"]: float("nan") if r["_base"] is None else r["_base"] for r in base.collect() if r["fold"] is not None}
    # a row for each fold: nothing that grows
    found = (met.rows.where("_parts = 1").groupBy("bucket")
             .applyInArrow(errors_of_folds(kinds, ks, folds, of_folds, met.opened), ERRORS))
    # a rating without a user or an item meets nobody
    each_kind = F.explode(F.sequence(F.lit(0), F.lit(len(kinds) - 1)))
    rows = own.where("a is null or over is null").withColumn("kind", each_kind).withColumn(
        "_p", F.array().cast("array<struct<k:int,p:double>>"))
    if met.parts > 1:
        types = dict(ratings.dtypes)
        near = (met.rows.where("_parts > 1").groupBy("bucket")
                .applyInArrow(nearest_of_folds(kinds, max(ks), folds, met.opened),
                              f"a {types[of]}, over {types[over]}, kind int, b {types[of]}, sim double, y double"))
        near = top_k_per_group(near, ["a", "over", "kind"], [F.desc("sim"), F.asc("b")], max(ks), "rn")
        drawn = (near.withColumn("k", F.explode(F.array(*map(F.lit, ks)))).where("rn <= k").groupBy("a", "over", "kind", "k")
                 .agg((F.sum(F.col("sim") * F.col("y")) / F.sum("sim")).alias("p"))
                 .groupBy("a", "over", "kind").agg(F.collect_list(F.struct("k", "p")).alias("_p")))
        asked = own.where("over is not null").join(met.hot, "a", "left_semi").withColumn("kind", each_kind)
        rows = rows.unionByName(asked.join(drawn, ["a", "over", "kind"], "left"))
    none = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(None).cast("double").alias("p")) for k in ks])
    full = F.when(F.size("_p") > 0, F.col("_p")).otherwise(none)
    gap = F.col("rating") - clip_rating(F.coalesce("p", "_base"))
    plain = (rows.withColumnRenamed("fa", "fold").join(F.broadcast(base), "fold").select("kind", "fold", "rating", "_base", F.inline(full))
             .groupBy("kind", "k", "fold").agg(F.count(gap).alias("n"), F.coalesce(F.sum(gap * gap), F.lit(0.0)).alias("squares"),
                                               F.coalesce(F.sum(F.abs(gap)), F.lit(0.0)).alias("gaps")))
    return found.unionByName(plain)


def knn_grid(ratings: DataFrame, ks: Sequence[int], kinds: Sequence[str], sides: Sequence[bool] = (True, False),
             folds: int = 5) -> DataFrame:
    """(kind, user_based, k, rmse, mae): mean of each measure over the folds, for every setting.

    ``ratings`` is (user_id, item_id, rating, fold), one row per pair.
    """
    totals = ratings.groupBy("fold").agg(F.sum("rating").alias("s"), F.count(F.lit(1)).alias("c"))
    every = totals.agg(F.sum("s").alias("s"), F.sum("c").alias("c"))
    # the mean of the other folds: one row per fold
    base = totals.select("fold", F.try_divide(every.select("s").scalar() - F.col("s"),
                                              every.select("c").scalar() - F.col("c")).alias("_base"))
    rows = reduce(DataFrame.unionByName, [side_errors(ratings, side, kinds, ks, folds, base).select(
        F.array(*map(F.lit, kinds))[F.col("kind")].alias("kind"), F.lit(side).alias("user_based"), "k", "fold", "n", "squares", "gaps")
        for side in sides])
    mean = lambda total: F.try_divide(F.sum(total), F.sum("n"))
    per_fold = rows.groupBy("kind", "user_based", "k", "fold").agg(F.sqrt(mean("squares")).alias("rmse"), mean("gaps").alias("mae"))
    return per_fold.groupBy("kind", "user_based", "k").agg(F.avg("rmse").alias("rmse"), F.avg("mae").alias("mae"))
