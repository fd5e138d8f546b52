"""Histograms over fixed, quantile and equal-width bins.

Quantile work starts from a frequency table (value, rows): the big shuffle is
a combined count, and edges and bins then come from distinct values only.
Edges and ranges enter the projection as scalar subqueries; nothing is
collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.functions import binning
from tastegrid.operators.ranking import exact_quantiles


def cut_histogram(frame: DataFrame, value: str, edges: Sequence[float], labels: Sequence[str],
                  right: bool = True) -> DataFrame:
    """Rows per fixed bin in bin order; empty bins stay with 0."""
    spark = frame.sparkSession
    number = binning.cut(F.col(value), edges, right)
    counted = (frame.select(number.alias("bucket")).where(F.col("bucket").isNotNull())
               .groupBy("bucket").agg(F.count(F.lit(1)).alias("count")))
    bins = spark.range(1, len(labels) + 1).select(F.col("id").cast("int").alias("bucket"))
    return (bins.join(counted, "bucket", "left")
            .select("bucket", binning.bin_label(F.col("bucket"), labels).alias("label"),
                    F.coalesce("count", F.lit(0)).alias("count"))
            .orderBy("bucket"))


def value_frequency(frame: DataFrame, value: str) -> DataFrame:
    """(value, n), NULL left out."""
    return (frame.select(F.col(value).cast("double").alias("value"))
            .where(F.col("value").isNotNull())
            .groupBy("value").agg(F.count(F.lit(1)).alias("n")))


def quantile_edges(freq: DataFrame, q: int = 10) -> DataFrame:
    """One row: the distinct interpolated quantiles of a frequency table, rising."""
    found = exact_quantiles(freq, [i / q for i in range(q + 1)])
    return found.select(F.array_distinct("quantiles").alias("edges"))


def quantile_bins(frame: DataFrame, value: str, q: int = 10, name: str = "bucket") -> DataFrame:
    """Add the quantile bin of each row: right side closed, lowest value included,
    equal edges merged."""
    edges = quantile_edges(value_frequency(frame, value), q).scalar()
    return frame.withColumn(name, binning.edge_bin(F.col(value).cast("double"), edges, q))


def quantile_histogram(frame: DataFrame, value: str, q: int = 10, ascending: bool = True) -> DataFrame:
    """Rows per quantile bin with the bin's edges; empty bins stay with 0."""
    freq = value_frequency(frame, value)
    edges = quantile_edges(freq, q)
    counted = (freq.select(binning.edge_bin(F.col("value"), edges.scalar(), q).alias("bucket"), "n")
               .groupBy("bucket").agg(F.sum("n").alias("count")))
    last = F.greatest(F.size("edges") - 1, F.lit(1))
    bins = (edges.where(F.size("edges") > 0)
            .select(F.explode(F.sequence(F.lit(1), last)).alias("bucket"), "edges")
            .select("bucket", F.element_at("edges", F.col("bucket")).alias("lo"),
                    F.element_at("edges", F.least(F.col("bucket") + 1, F.size("edges"))).alias("hi")))
    return (bins.join(counted, "bucket", "left")
            .select("bucket", "lo", "hi", F.coalesce("count", F.lit(0)).alias("count"))
            .orderBy(F.asc("bucket") if ascending else F.desc("bucket")))


def width_histogram(frame: DataFrame, *values: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram of each column: column, bucket, lo, hi, count; empty bins stay with 0.

    All columns share one pass for the ranges and one for the counts.
    """
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in values]
    tall = frame.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull())
    limits = {c: F.struct(F.min(F.col(c).cast("double")).alias("lo"),
                          F.max(F.col(c).cast("double")).alias("hi")) for c in values}
    ranges = frame.agg(F.create_map(*[x for c, s in limits.items() for x in (F.lit(c), s)]).alias("spans"))
    spans = ranges.scalar()
    counted = (tall.withColumn("_span", F.element_at(spans, F.col("column")))
               .groupBy("column", binning.width_bin(F.col("value"), F.col("_span.lo"), F.col("_span.hi"), bins)
                        .alias("bucket"))
               .agg(F.count(F.lit(1)).alias("count")))
    every = (ranges.select(F.explode("spans").alias("column", "_span")).where(F.col("_span.lo").isNotNull())
             .select("column", F.col("_span.lo").alias("_lo"), F.col("_span.hi").alias("_hi"),
                     F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bucket")))
    step = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    return every.join(counted, ["column", "bucket"], "left").select(
        "column", "bucket", (F.col("_lo") + step * (F.col("bucket") - 1)).alias("lo"),
        (F.col("_lo") + step * F.col("bucket")).alias("hi"), F.coalesce("count", F.lit(0)).alias("count"))


def month_histogram(frame: DataFrame, date: str) -> DataFrame:
    """Rows per calendar month, months without rows included."""
    counted = (frame.where(F.col(date).isNotNull()).groupBy(F.month(date).alias("month"))
               .agg(F.count(F.lit(1)).alias("_n")))
    months = frame.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("month"))
    return (months.join(counted, "month", "left").select("month", F.coalesce("_n", F.lit(0)).alias("count"))
            .orderBy("month"))


def scatter_grid(frame: DataFrame, x: str, y: str, x_step: float, y_step: float) -> DataFrame:
    """Scatter data as a grid of counts, bounded by the plotted area and not by the rows."""
    cell = [(F.floor(F.col(c).cast("double") / F.lit(step)) * F.lit(step)).alias(c)
            for c, step in ((x, x_step), (y, y_step))]
    return (frame.na.drop(subset=[x, y]).groupBy(*cell).agg(F.count(F.lit(1)).alias("count")))
