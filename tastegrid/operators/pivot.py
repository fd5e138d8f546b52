"""The user-item matrix of ratings as sparse rows and blocks (RC13).

One column per item would not hold; a user is a row with sorted item numbers and
their ratings.  An active user's row is cut into parts of at most ``part_items``
item numbers each, so no row grows with the activity of a user.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.operators.neighbours import Pairs, with_raters
from tastegrid.session import spread

PART_ITEMS = 4_096


def sparse_rows(ratings: DataFrame, numbers: DataFrame, part_items: int = PART_ITEMS, many: int = 0) -> DataFrame:
    """(user_id, part, n, idx, rating): entry arrays sorted by item number.

    ``numbers`` is (raw_id, idx) of the items.  A part holds the item numbers of
    one stretch of ``part_items``; a repeated pair keeps its mean rating.  ``many``
    is about the number of ratings, by which the tasks rise.
    """
    known = numbers.select(F.col("raw_id").alias("item_id"), "idx")
    cells = (spread(ratings, many, "user_id", "item_id").groupBy("user_id", "item_id").agg(F.avg("rating").alias("rating"))
             .join(known, "item_id"))
    entries = F.sort_array(F.collect_list(F.struct("idx", "rating")))
    placed = cells.select("user_id", F.floor(F.col("idx") / part_items).cast("long").alias("part"), "idx", "rating")
    return (spread(placed, many, "user_id", "part").groupBy("user_id", "part").agg(entries.alias("_e"))
            .select("user_id", "part", F.size("_e").alias("n"), F.col("_e.idx").alias("idx"), F.col("_e.rating").alias("rating")))


def unpivoted(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """(user_id, item_id, rating) of sparse rows: the cells that are not empty."""
    cells = rows.select("user_id", F.inline(F.arrays_zip("idx", "rating")))
    return cells.join(numbers, "idx").select("user_id", F.col("raw_id").alias("item_id"), "rating")


def user_products(rows: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """(a, b, sxy, n): the matrix times its transpose, for asked (or all) users a against all users b they share items with.

    A bucket holds all lists of raters that its users meet, so a pair is added up
    where it is formed and is never shuffled.
    """
    cells = rows.select("user_id", F.inline(F.arrays_zip("idx", "rating")))
    left = cells if asked is None else cells.join(asked.select("user_id").distinct(), "user_id", "left_semi")
    met = with_raters(left.select(F.col("idx").alias("over"), F.col("user_id").alias("a"), F.col("rating").alias("x")),
                      cells.select(F.col("idx").alias("over"), F.col("user_id").alias("b"), F.col("rating").alias("y")))
    kind = dict(rows.dtypes)["user_id"]
    opened = met.opened
    return met.rows.groupBy("bucket").applyInArrow(lambda table: products(opened(table)), f"a {kind}, b {kind}, sxy double, n long")


def products(table: pa.Table) -> pa.Table:
    """The sums of a bucket of ``with_raters``."""
    pairs = Pairs(table)
    sums = pairs.sums(pairs.of_row("x"), pairs.of_list("y"), np.arange(len(pairs.row)))
    a, b = np.divmod(pairs.keys, max(1, len(pairs.names)))
    return pa.table([pairs.names.take(pa.array(a)), pairs.names.take(pa.array(b)), pa.array(sums["sxy"], from_pandas=True),
                     pa.array(sums["n"])], names=["a", "b", "sxy", "n"])


def dense_pivot(ratings: DataFrame, items: list) -> DataFrame:
    """One row per user and one column per given item, empty cells null; for a short list of items."""
    cells = ratings.where(F.col("item_id").isin(*items))
    return cells.groupBy("user_id").agg(*[
        F.avg(F.when(F.col("item_id") == i, F.col("rating"))).alias(f"item_{i}") for i in items])
