"""Feature encoding.  Data-dependent labels stay rows; wide forms are views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastegrid.functions import text as tx
from tastegrid.operators.ranking import rank_in_group


def list_to_rows(frame: DataFrame, column: str, name: str, keep_empty: bool = False) -> DataFrame:
    """One row per list element; NULL and empty lists vanish or stay as one NULL row."""
    explode = F.explode_outer if keep_empty else F.explode
    rest = [c for c in frame.columns if c != column]
    return frame.select(*rest, explode(column).alias(name))


def labels_of(frame: DataFrame, key: str, column: str, name: str = "label",
              keep_spaces: bool = False) -> DataFrame:
    """(key, label) rows from a list, or from a list held as text; each pair once.

    Duplicates inside one list are removed in the row, before any shuffle, so
    the result is a plain projection when ``key`` is unique.
    """
    lists = F.col(column)
    if dict(frame.dtypes)[column] == "string":
        lists = tx.list_from_text(lists, keep_spaces)
    return frame.select(key, F.explode(F.array_distinct(lists)).alias(name)).where(F.col(name) != "")


def multi_hot_long(labels: DataFrame, key: str, label: str, prefix: str = "") -> DataFrame:
    """(key, feature, 1.0) rows."""
    return labels.select(key, F.concat(F.lit(prefix), F.col(label)).alias("feature"),
                         F.lit(1.0).alias("value"))


def label_list(labels: DataFrame, label: str, most: int = 2000) -> list[str]:
    """All labels, sorted, of a column that has at most ``most`` different ones.

    Only such a list can become columns; a larger one raises and belongs in rows.
    """
    found = labels.where(F.col(label).isNotNull()).select(label).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} labels in {label}: use the long form")
    return sorted(r[0] for r in found)


def multi_hot_wide(labels: DataFrame, key: str, label: str, values: Sequence[str] | None = None) -> DataFrame:
    """One 0/1 column per label, sorted: of the given labels, or of all there are."""
    values = label_list(labels, label) if values is None else sorted(values)
    return labels.groupBy(key).agg(*[
        F.max(F.coalesce((F.col(label) == v).cast("int"), F.lit(0))).alias(v) for v in values])


def attach_labels(frame: DataFrame, column: str, values: Sequence[str] | None = None) -> DataFrame:
    """``frame`` with a 0/1 column per label in its list ``column``, which goes; a missing list has none.

    The list stands in the row it encodes, so nothing is joined.
    """
    if values is None:
        values = label_list(frame.select(F.explode(column).alias("label")), "label")
    rest = [c for c in frame.columns if c != column]
    return frame.select(*rest, *[F.coalesce(F.array_contains(column, v).cast("int"), F.lit(0)).alias(v)
                                 for v in sorted(values)])


def vocabulary(labels: DataFrame, label: str) -> DataFrame:
    """Number of distinct labels."""
    return labels.agg(F.count_distinct(label).alias("labels"))


def min_max(frame: DataFrame, columns: Sequence[str], suffix: str = "_std") -> DataFrame:
    """Scale columns to 0..1; a constant column becomes 0.  One pass finds all ranges."""
    limits = frame.agg(F.struct(*[
        F.struct(F.min(F.col(c).cast("double")).alias("lo"),
                 F.max(F.col(c).cast("double")).alias("hi")).alias(c) for c in columns])).scalar()

    def scaled(c: str):
        lo, hi = limits[c]["lo"], limits[c]["hi"]
        value = F.col(c).cast("double")
        share = (value - lo) / F.nullif(hi - lo, F.lit(0.0))
        return F.when(value.isNotNull(), F.coalesce(share, F.lit(0.0)))
    return frame.withColumns({f"{c}{suffix}": scaled(c) for c in columns})


def melt(frame: DataFrame, key: str, columns: Sequence[str], keep_nulls: bool = False) -> DataFrame:
    """Wide numeric columns to (key, feature, value) rows."""
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]
    long = frame.select(key, F.inline(F.array(*pairs)))
    return long if keep_nulls else long.where(F.col("value").isNotNull())


def stacked_features(parts: Sequence[DataFrame], key: str) -> DataFrame:
    """(key, feature, value) rows of the keys that every part has, without null values.

    The parts are read once each and meet in one shuffle on ``key``, whose rows
    are bounded by the feature names.  A key counts as a part's by any row of it.
    """
    marked = [part.select(key, "feature", "value", F.lit(n).alias("_part")) for n, part in enumerate(parts)]
    rows = reduce(DataFrame.unionByName, marked).where(F.col(key).isNotNull())
    group = Window.partitionBy(key)
    held = rows.withColumns({f"_has{n}": F.max((F.col("_part") == n).cast("int")).over(group)
                             for n in range(len(parts))})
    return held.where(" and ".join(f"_has{n} = 1" for n in range(len(parts)))).where(
        F.col("value").isNotNull()).select(key, "feature", "value")


def present_features(features: DataFrame, key: str) -> DataFrame:
    """Feature list of each item: names with a value over 0 plus the item itself.

    Weights sum to 1 per item; the size of the value is dropped.  An item's list is
    bounded by the feature names, and ``features`` is planned once.
    """
    listed = features.groupBy(key).agg(F.collect_list(F.when(F.col("value") > 0, F.col("feature"))).alias("_f"))
    own = F.array(F.concat(F.lit("id:"), F.col(key).cast("string")))
    return (listed.withColumn("_f", F.concat("_f", own))
            .select(key, F.explode("_f").alias("feature"), (F.lit(1.0) / F.size("_f")).alias("weight")))


def id_map(frame: DataFrame, column: str, digits: int = 3) -> DataFrame:
    """(raw_id, idx): dense numbers 0.. in hash order of the ids.

    The hash prefix splits the ids into parts that are numbered apart, so the
    distinct ids need not fit one task, and the numbers repeat on every run.
    """
    ids = frame.select(F.col(column).alias("raw_id")).where(F.col("raw_id").isNotNull()).distinct()
    hashed = ids.withColumn("_hash", F.md5(F.col("raw_id").cast("string")))
    ranked = rank_in_group(hashed, [], F.substr("_hash", F.lit(1), F.lit(digits)),
                           [F.asc("_hash"), F.asc("raw_id")])
    return ranked.select("raw_id", (F.col("rank") - 1).alias("idx"))


def one_hot(frame: DataFrame, columns: Mapping[str, Sequence[object]]) -> DataFrame:
    """``<column>_<value>`` 0/1 columns in place of categorical columns."""
    flags = [F.coalesce((F.col(c) == v).cast("int"), F.lit(0)).alias(f"{c}_{v}")
             for c, values in columns.items() for v in values]
    rest = [c for c in frame.columns if c not in columns]
    return frame.select(*rest, *flags)


def implicit_interactions(events: DataFrame, items: DataFrame, flag: str = "is_recommended",
                          user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Positive rows of known items as (user_id, item_id, weight 1.0), ids as text."""
    known = items.select(item).distinct()
    return (events.where(F.col(flag)).join(known, item, "left_semi")
            .select(F.col(user).cast("string").alias("user_id"),
                    F.col(item).cast("string").alias("item_id"), F.lit(1.0).alias("weight")))
