"""Counts, shares, means, correlations and summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.operators.ranking import exact_quantiles


def count_per(frame: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    """Rows per key; keys that are NULL are no group."""
    return frame.na.drop(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def frequency(frame: DataFrame, key: str, name: str = "count") -> DataFrame:
    """Rows per key, most frequent first, ties by key."""
    return count_per(frame, key, name=name).orderBy(F.desc(name), F.asc(key))


def distinct_count(frame: DataFrame, *columns: str, approximate: float | None = None) -> DataFrame:
    """Distinct values per column in one row; ``approximate`` is the allowed relative error."""
    if approximate is None:
        return distinct_sizes(frame, *columns).drop("rows")
    return frame.agg(*[F.approx_count_distinct(c, approximate).alias(c) for c in columns])


def distinct_sizes(frame: DataFrame, *columns: str) -> DataFrame:
    """One row: ``rows``, and for each column how many different values it has, NULL left out.

    Rows are combined per combination of values first; only what is left is told
    apart by column.  ``frame`` is planned once.
    """
    combined = frame.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    sides = [F.struct(F.lit(i).alias("_c"), F.col(c).cast("string").alias("_v")) for i, c in enumerate(columns)]
    values = combined.select("_n", F.inline(F.array(*sides))).groupBy("_c", "_v").agg(F.sum("_n").alias("_n"))
    return values.agg(F.coalesce(F.sum(F.when(F.col("_c") == 0, F.col("_n"))), F.lit(0)).alias("rows"), *[
        F.count_if((F.col("_c") == i) & F.col("_v").isNotNull()).alias(c) for i, c in enumerate(columns)])


def distinct_values(frame: DataFrame, column: str) -> DataFrame:
    """Each value once."""
    return frame.select(column).distinct()


def first_per_key(frame: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key, the first in a declared order.

    ``min_by`` over the whole row combines before the shuffle, so a key held by
    a third of the rows costs no more than any other.
    """
    rest = [c for c in frame.columns if c != key]
    return (frame.groupBy(key)
            .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
            .select(key, *[F.col("_row")[c].alias(c) for c in rest]))


def flag_totals(frame: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    """One row per flag: label and number of rows with it set."""
    sums = frame.agg(*[F.coalesce(F.sum(F.col(c).cast("bigint")), F.lit(0)).alias(c)
                       for c in flags.values()])
    rows = [F.struct(F.lit(label).alias("label"), F.col(c).alias("count")) for label, c in flags.items()]
    return sums.select(F.inline(F.array(*rows)))


def group_mean(frame: DataFrame, key: str, value: str, digits: int | None = None,
               name: str = "mean") -> DataFrame:
    """Mean per key, rounded on request."""
    mean = F.avg(F.col(value).cast("double"))
    return frame.groupBy(key).agg((mean if digits is None else F.round(mean, digits)).alias(name))


def with_overall_mean(grouped: DataFrame, detail: DataFrame, value: str,
                      name: str = "overall_mean") -> DataFrame:
    """Put the mean over ``detail`` beside grouped rows, as a scalar subquery."""
    overall = detail.agg(F.avg(F.col(value).cast("double"))).scalar()
    return grouped.withColumn(name, overall)


def groups_over(frame: DataFrame, key: str, threshold: int) -> DataFrame:
    """How many keys have more than ``threshold`` rows."""
    return count_per(frame, key).agg(F.count_if(F.col("count") > threshold).alias("groups"))


def having_count(frame: DataFrame, key: str, more_than: int | None = None,
                 less_than: int | None = None) -> DataFrame:
    """Keys whose number of rows is within the bounds."""
    sizes = count_per(frame, key)
    if more_than is not None:
        sizes = sizes.where(F.col("count") > more_than)
    if less_than is not None:
        sizes = sizes.where(F.col("count") < less_than)
    return sizes


def share_of_values(frame: DataFrame, column: str, values: Sequence[object],
                    name: str = "share") -> DataFrame:
    """Share of rows whose value is one of ``values``."""
    hit = F.coalesce(F.col(column).isin(*values), F.lit(False)).cast("double")
    return frame.agg(F.avg(hit).alias(name))


def density(frame: DataFrame, user: str, item: str) -> DataFrame:
    """Rows over users times items, with one pass over ``frame``."""
    filled = F.try_divide(F.col("rows").cast("double"), F.col("users").cast("double") * F.col("items"))
    return (distinct_sizes(frame, user, item).select("rows", F.col(user).alias("users"), F.col(item).alias("items"))
            .withColumns({"density": filled, "sparsity": F.lit(1.0) - filled}))


def safe_corr(x: str, y: str) -> Column:
    """Pearson correlation over pairs without NULL; NULL when a side is constant."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a = F.when(both, F.col(x).cast("double"))
    b = F.when(both, F.col(y).cast("double"))
    varied = (F.min(a) < F.max(a)) & (F.min(b) < F.max(b))
    covariance = F.covar_pop(a, b)
    spread = F.nullif(F.stddev_pop(a) * F.stddev_pop(b), F.lit(0.0))
    return F.when(varied, covariance / spread)


def correlation(frame: DataFrame, x: str, y: str, name: str = "correlation") -> DataFrame:
    """Pearson correlation of two columns, one pass."""
    return frame.agg(safe_corr(x, y).alias(name))


def describe(frame: DataFrame, *columns: str) -> DataFrame:
    """Count, mean, deviation, minimum, quartiles and maximum, a row per column.

    Rows are counted per value first, and the exact quartiles are found by rank,
    so no reducer holds all values of a column.
    """
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    counted = (frame.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull())
               .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    quartiles = exact_quantiles(counted, (0.25, 0.5, 0.75), "column").withColumnRenamed("quantiles", "_q")
    total, mean = F.sum("n"), F.sum(F.col("value") * F.col("n")) / F.sum("n")
    spread = counted.groupBy("column").agg(
        total.alias("count"), mean.alias("mean"), F.min("value").alias("min"),
        F.max("value").alias("max")).join(quartiles, "column")
    squares = (counted.join(spread.select("column", "mean"), "column")
               .groupBy("column")
               .agg(F.sum(F.col("n") * F.pow(F.col("value") - F.col("mean"), F.lit(2.0))).alias("_ss")))
    return (spread.join(squares, "column")
            .select("column", "count", "mean",
                    F.sqrt(F.try_divide(F.col("_ss"), F.col("count") - 1)).alias("std"), "min",
                    F.col("_q")[0].alias("q25"), F.col("_q")[1].alias("q50"),
                    F.col("_q")[2].alias("q75"), "max"))


def column_range(frame: DataFrame, *columns: str) -> DataFrame:
    """Minimum and maximum of columns in one row: ``<c>_min``, ``<c>_max``."""
    return frame.agg(*[e for c in columns
                       for e in (F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"))])


def row_count(frame: DataFrame, name: str = "rows") -> DataFrame:
    """Number of rows."""
    return frame.agg(F.count(F.lit(1)).alias(name))


def share_of_total(frame: DataFrame, count: str = "count", digits: int = 1,
                   name: str = "percent") -> DataFrame:
    """Each row's part of the column total in percent."""
    total = frame.agg(F.sum(count)).scalar()
    return frame.withColumn(name, F.round(F.try_divide(F.col(count) * F.lit(100.0), total), digits))


def small_mean_vectors(frame: DataFrame, vector: str, below: float = 1e-3) -> DataFrame:
    """How many vectors have a mean under ``below``."""
    total = F.aggregate(F.col(vector), F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    mean = F.try_divide(total, F.size(vector).cast("double"))
    return frame.agg(F.count_if(mean < below).alias("small"), F.count(F.lit(1)).alias("vectors"))
