"""Top-k and exact ranks inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_n(frame: DataFrame, by: str, key: str, n: int, largest: bool = True) -> DataFrame:
    """The ``n`` rows with the largest (or smallest) ``by``, ties by key."""
    return frame.orderBy(F.desc(by) if largest else F.asc(by), F.asc(key)).limit(n)


def top_k_per_group(frame: DataFrame, group: str | Sequence[str], by: Sequence[Column], k: int,
                    name: str = "pos") -> DataFrame:
    """First ``k`` rows of each group in the order ``by``.

    The literal bound lets Spark cut each group to ``k`` rows on the map side,
    so no task ever receives a whole hot group.
    """
    keys = [group] if isinstance(group, str) else list(group)
    position = F.row_number().over(W.partitionBy(*keys).orderBy(*by))
    return frame.withColumn(name, position).where(F.col(name) <= k)


def rank_in_group(frame: DataFrame, group: Sequence[str], bucket: Column, order: Sequence[Column],
                  name: str = "rank") -> DataFrame:
    """Exact row number in each group, without sorting a whole group in one task.

    ``bucket`` must rise with the order (a hash prefix, a rounded score).  Rows
    are ranked inside (group, bucket); the sizes of the lower buckets are added
    from a small table of counts.
    """
    keys = list(group)
    marked = frame.withColumn("_bucket", bucket)
    sizes = marked.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = (W.partitionBy(*keys).orderBy("_bucket")
              .rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select(*keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = F.row_number().over(W.partitionBy(*keys, "_bucket").orderBy(*order))
    return (marked.withColumn("_local", local)
            .join(offsets, [*keys, "_bucket"], "inner")
            .withColumn(name, F.col("_before") + F.col("_local"))
            .drop("_bucket", "_local", "_before"))


def size_class(value: Column) -> Column:
    """A whole number that rises with the value: its sign and the logarithm of its size, 64 classes to a factor of e."""
    number = value.cast("double")
    grade = F.floor(F.log(F.greatest(F.abs(number), F.lit(1e-300))) * 64) + 44300
    return (F.signum(number) * grade).cast("long")


def exact_quantiles(freq: DataFrame, shares: Sequence[float], group: str | None = None) -> DataFrame:
    """(group, quantiles): interpolated quantiles of a table (group, value, n), without all values in one task.

    Values are summed up within classes of like size; the class totals place each
    value's ranks, and a quantile is what holds the rank below and the rank above.
    """
    keys = [] if group is None else [group]
    marked = freq.withColumn("_class", size_class(F.col("value")))
    totals = marked.groupBy(*keys, "_class").agg(F.sum("n").alias("_n"))
    of_group = W.partitionBy(*keys)
    before = of_group.orderBy("_class").rowsBetween(W.unboundedPreceding, W.currentRow)
    offsets = totals.select(*keys, "_class", (F.sum("_n").over(before) - F.col("_n")).alias("_before"),
                            F.sum("_n").over(of_group).alias("_all"))
    upto = F.sum("n").over(W.partitionBy(*keys, "_class").orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow))
    placed = (marked.withColumn("_end", upto).join(offsets, [*keys, "_class"])
              .select(*keys, "value", "_all", (F.col("_before") + F.col("_end") - F.col("n")).alias("_from"),
                      (F.col("_before") + F.col("_end")).alias("_to")))
    place = lambda p: F.lit(float(p)) * (F.col("_all") - 1)
    holds = lambda rank: (F.col("_from") <= rank) & (rank < F.col("_to"))
    asked = [F.struct(F.lit(i).alias("i"), place(p).alias("at"), holds(F.floor(place(p))).alias("low"),
                      holds(F.ceil(place(p))).alias("high")) for i, p in enumerate(shares)]
    hits = placed.select(*keys, "value", F.inline(F.array(*asked))).where("low or high")
    ends = hits.groupBy(*keys, "i").agg(F.max("at").alias("at"), F.max(F.when(F.col("low"), F.col("value"))).alias("a"),
                                        F.max(F.when(F.col("high"), F.col("value"))).alias("b"))
    between = (F.ceil("at") - F.col("at")) * F.col("a") + (F.col("at") - F.floor("at")) * F.col("b")
    value = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(between)
    listed = F.sort_array(F.collect_list(F.struct("i", value.alias("v"))))
    return ends.groupBy(*keys).agg(listed.alias("_q")).select(*keys, F.col("_q.v").alias("quantiles"))


def best_by(frame: DataFrame, metric: str, *ties: str) -> DataFrame:
    """The one row with the highest metric."""
    return frame.orderBy(F.desc(metric), *[F.asc(t) for t in ties]).limit(1)
