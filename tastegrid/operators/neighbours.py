"""Neighbourhood models on ratings as joins and sums (RC2-RC5).

Similarities are formed only between what is asked for and the rest.  What is asked
for (a) is dealt by hash into buckets of about ``PAIRS`` pairs of ratings, and to each
rating of an ``a`` go the raters of the same thing as lists: 16 bytes a pair in one
shuffle.  A bucket knows all pairs of its ``a`` and adds them up alone.  An ``a`` of
more pairs is cut into parts by a hash of the other side.  A key with many rows on
both sides is cut into square blocks, each of at most ``block_rows`` rows a side;
nothing is left out.  Rows of whole-numbered ids are packed by bucket before they
travel, which takes less than half of their bytes.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tastegrid.functions import hashing
from tastegrid.functions.ratings import clip_rating
from tastegrid.operators.ranking import top_k_per_group
from tastegrid.operators.stored import written
from tastegrid.session import task_slots

PAIRS = 1 << 20
LIST_ROWS = 4_096
PACKED_PAIRS = 1 << 21  # a task packs so many pairs at a time

def in_blocks(left: DataFrame, right: DataFrame, key: str, left_id: str, right_id: str,
              block_rows: int = 4096) -> DataFrame:
    """Inner join on ``key``, with large keys cut into blocks of pairs."""
    sizes = (left.groupBy(key).agg(F.count(F.lit(1)).alias("_l")).join(
        right.groupBy(key).agg(F.count(F.lit(1)).alias("_r")), key))
    cuts = sizes.select(key, F.ceil(F.col("_l") / block_rows).cast("int").alias("_cl"),
                        F.ceil(F.col("_r") / block_rows).cast("int").alias("_cr"))

    def dealt(frame: DataFrame, own: str, other: str, row_id: str) -> DataFrame:
        block = F.pmod(F.xxhash64(row_id), F.col(f"_c{own}")).cast("int")
        return (frame.join(cuts, key).withColumn(f"_b{own}", block)
                .withColumn(f"_b{other}", F.explode(F.sequence(F.lit(0), F.col(f"_c{other}") - 1)))
                .drop("_cl", "_cr"))

    return dealt(left, "l", "r", left_id).join(dealt(right, "r", "l", right_id), [key, "_bl", "_br"]).drop("_bl", "_br")


class Met(NamedTuple):
    """``rows`` by ``bucket``, the most parts that an ``a`` has, what opens the rows of a bucket in a task, and every ``a`` of several parts."""

    rows: DataFrame
    parts: int
    opened: Callable[[pa.Table], pa.Table]
    hot: DataFrame


def with_raters(left: DataFrame, right: DataFrame, pairs: int | None = None) -> Met:
    """Bring the raters of a thing to every ``a`` that has it.

    ``left`` is (over, a, ...) and ``right`` (over, b, ...); a row of ``left`` meets the
    rows of ``right`` with its ``over``, in lists of about ``LIST_ROWS`` rows at most.
    Rows of one part of an ``a`` share a bucket; those of an ``a`` of several parts
    have ``_parts`` over 1.  Opened, they are the columns of ``left`` and lists of those
    of ``right``, by their names.
    """
    most = PAIRS if pairs is None else pairs
    left, right = left.where("a is not null"), right.where("b is not null")
    sizes = right.groupBy("over").agg(F.count(F.lit(1)).alias("_n"))
    load = written(left.join(sizes, "over").groupBy("a").agg(F.sum("_n").alias("_pairs")), "pairs-of-rows")
    whole, largest = load.agg(F.sum("_pairs"), F.max("_pairs")).first()
    buckets, parts = -(-(whole or 1) // most), -(-(largest or 1) // most)
    chunk = F.pmod(F.xxhash64("b"), F.ceil(F.col("_n") / LIST_ROWS)).cast("int")
    values = [c for c in right.columns if c not in ("over", "b")]
    lists = (right.join(sizes, "over").groupBy("over", chunk.alias("_chunk"))
             .agg(F.sort_array(F.collect_list(F.struct("b", *values))).alias("_list")))
    dealt = (left.join(load, "a").withColumn("_parts", F.ceil(F.col("_pairs") / most).cast("int"))
             .withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_pairs"))
    met = in_blocks(dealt, lists, "over", "a", "_chunk")
    if parts > 1:
        own = F.filter("_list", lambda r: F.pmod(F.xxhash64(r["b"]), F.col("_parts")) == F.col("_part"))
        met = met.withColumn("_list", F.when(F.col("_parts") > 1, own).otherwise(F.col("_list")))
    rows = met.select(F.pmod(F.xxhash64("a", "_part"), F.lit(buckets)).alias("bucket"), "_parts", *left.columns,
                      *[F.col(f"_list.{c}").alias(c) for c in ("b", *values)])
    opened = lambda table: table
    if all(isinstance(rows.schema[c].dataType, IntegralType) for c in ("over", "a")) and isinstance(
            right.schema["b"].dataType, IntegralType):
        ids, facts = ("over", "a"), [c for c in left.columns if c not in ("over", "a")]
        rows = rows.mapInArrow(packing(ids, facts, values), "bucket long, _parts int, packed binary")
        opened = opening(ids, facts, values, dict(left.dtypes) | dict(right.dtypes))
    tasks = max(min(buckets, 2 * task_slots(left.sparkSession)), buckets // 2)
    return Met(rows.repartition(tasks, "bucket"), parts, opened, load.where(F.col("_pairs") > most).select("a"))


def _planes(words: np.ndarray) -> bytes:
    """The first bytes of all 8-byte words, the second ones, and so on: like bytes side by side pack well."""
    return words.view(np.uint8).reshape(-1, 8).T.tobytes()


def _words(planes: np.ndarray, kind: type) -> np.ndarray:
    return np.ascontiguousarray(planes.reshape(8, -1).T).view(kind).ravel()


def packing(ids: Sequence[str], facts: Sequence[str], values: Sequence[str]) -> Callable[
        [Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pack rows with lists: one row for the rows of a bucket that a task holds at a time.

    Ids are whole numbers, those of ``b`` rising in each list; facts and the lists of
    ``values`` are numbers a double holds.
    """
    def numbers(column: pa.Array) -> np.ndarray:
        return column.cast(pa.float64()).to_numpy(zero_copy_only=False)

    def emit(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        key = rows["bucket"].to_numpy() * 2 + (rows["_parts"].to_numpy() > 1)
        order = np.lexsort((rows["a"].to_numpy(), key))
        rows, key = rows.take(pa.array(order)).combine_chunks(), key[order]
        lists = {c: rows[c].combine_chunks() for c in ("b", *values)}
        sizes = pc.list_value_length(lists["b"]).to_numpy().astype(np.int64)
        ends = np.cumsum(sizes)
        b = lists["b"].flatten().to_numpy().astype(np.int64)
        gaps = np.diff(b, prepend=0)
        first = (ends - sizes)[sizes > 0]
        gaps[first] = b[first]
        of_rows = [rows[c].to_numpy().astype(np.int64) for c in ids] + [sizes] + [numbers(rows[c].combine_chunks()) for c in facts]
        of_pairs = [gaps] + [numbers(lists[c].flatten()) for c in values]
        codec = pa.Codec("zstd", 1)
        cuts = np.flatnonzero(np.diff(key, prepend=-1, append=-1))
        out = []
        for at, to in zip(cuts[:-1], cuts[1:], strict=True):
            begin, end = ends[at] - sizes[at], ends[to - 1]
            raw = b"".join([_planes(c[at:to]) for c in of_rows] + [_planes(c[begin:end]) for c in of_pairs])
            out.append(struct.pack("<qq", to - at, end - begin) + codec.compress(raw, asbytes=True))
        key = key[cuts[:-1]]
        return pa.record_batch([pa.array(key // 2), pa.array((key % 2 + 1).astype(np.int32)), pa.array(out, pa.binary())],
                               names=["bucket", "_parts", "packed"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                many += batch.num_rows + len(batch["b"].flatten())
            if many >= PACKED_PAIRS:
                yield emit(held)
                held, many = [], 0
        if held:
            yield emit(held)
    return work


def opening(ids: Sequence[str], facts: Sequence[str], values: Sequence[str], types: Mapping[str, str]) -> Callable[
        [pa.Table], pa.Table]:
    """The rows that ``packing`` packed; ``types`` are those of Spark."""
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8(), "double": pa.float64(),
             "boolean": pa.bool_()}

    def work(table: pa.Table) -> pa.Table:
        of_rows, of_pairs = {c: [] for c in (*ids, "", *facts)}, {c: [] for c in ("b", *values)}
        for packed in table["packed"].to_pylist():
            rows, pairs = struct.unpack_from("<qq", packed)
            raw = np.frombuffer(pa.decompress(packed[16:], 8 * (rows * len(of_rows) + pairs * len(of_pairs)), "zstd"), np.uint8)
            at = 0
            for found, many in ((of_rows, rows), (of_pairs, pairs)):
                for c, kept in found.items():
                    kept.append(_words(raw[at:at + 8 * many], np.int64 if c in (*ids, "", "b") else np.float64))
                    at += 8 * many
            # numbers from the gaps; a list's first is whole
            sizes, gaps = of_rows[""][-1], of_pairs["b"][-1]
            first = (np.cumsum(sizes) - sizes)[sizes > 0]
            sums = np.cumsum(gaps)
            of_pairs["b"][-1] = sums - np.repeat(sums[first] - gaps[first], sizes[sizes > 0])
        joined = {c: np.concatenate(x) if x else np.zeros(0) for c, x in (of_rows | of_pairs).items()}
        column = lambda c: pa.array(joined[c], from_pandas=True).cast(kinds[types[c]])
        offsets = pa.array(np.concatenate([[0], np.cumsum(joined[""])]).astype(np.int32))
        return pa.table({c: column(c) for c in (*ids, *facts)}
                        | {c: pa.ListArray.from_arrays(offsets, column(c)) for c in ("b", *values)})
    return work


def ranked(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The place of each value among the different ones, and these in their order."""
    found = values.dictionary_encode()
    order = pc.sort_indices(found.dictionary)
    places = np.empty(len(order), dtype=np.int64)
    places[order.to_numpy()] = np.arange(len(order))
    return places[found.indices.to_numpy()], found.dictionary.take(order)


class Pairs:
    """The pairs of a bucket, one place each in arrays: ``row`` of the table, ``a`` and ``b`` as places among ``names``.

    ``of`` has the ``a`` of every row of the table.
    """

    def __init__(self, rows: pa.Table):
        lists = rows["b"].combine_chunks()
        row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
        ids, self.names = ranked(pa.concat_arrays([rows["a"].combine_chunks(), lists.flatten()]))
        self.of = ids[:len(lists)]
        a, b = self.of[row], ids[len(lists):]
        self.other = np.flatnonzero(a != b)
        self.row, self.a, self.b = row[self.other], a[self.other], b[self.other]
        self.keys, self.key = np.unique(self.a * len(self.names) + self.b, return_inverse=True)
        self.rows = rows

    def of_row(self, column: str) -> np.ndarray:
        return self.rows[column].to_numpy()[self.row]

    def of_list(self, column: str) -> np.ndarray:
        return self.rows[column].combine_chunks().flatten().to_numpy(zero_copy_only=False)[self.other]

    def sums(self, x: np.ndarray, y: np.ndarray, among: np.ndarray) -> dict[str, np.ndarray]:
        """Sums per key over the pairs ``among``; a sum of nothing but nulls is NaN."""
        key, x, y = self.key[among], x[among].astype(np.float64), y[among].astype(np.float64)
        holes = bool(np.isnan(x).any() or np.isnan(y).any())

        def total(value: np.ndarray) -> np.ndarray:
            if not holes:
                return np.bincount(key, value, len(self.keys))
            some = np.bincount(key[~np.isnan(value)], minlength=len(self.keys))
            return np.where(some, np.bincount(key, np.nan_to_num(value), len(self.keys)), np.nan)

        return {"n": np.bincount(key, minlength=len(self.keys)), "sx": total(x), "sy": total(y), "sxy": total(x * y),
                "sxx": total(x * x), "syy": total(y * y), "sd": total((x - y) ** 2)}

    def first(self, group: np.ndarray, sim: np.ndarray, b: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The places of the ``k`` most alike of each group, ties by ``b``, and their ranks from 0."""
        if len(group) and np.bincount(group).max() <= k:  # nothing is left out, and no rank is asked
            return np.arange(len(group)), np.zeros(len(group), dtype=np.int64)
        order = np.lexsort((b, -sim, group))
        rank = np.arange(len(order)) - np.searchsorted(group[order], group[order])
        return order[rank < k], rank[rank < k]


def likeness(kind: str, sums: Mapping[str, np.ndarray]) -> np.ndarray:
    """Similarities from the sums over common keys; NaN where there is none."""
    n, x, y = sums["n"], sums["sx"], sums["sy"]
    with np.errstate(divide="ignore", invalid="ignore"):
        if kind == "msd":
            return np.where(n > 0, 1.0 / (sums["sd"] / n + 1.0), np.nan)
        if kind == "cosine":
            lengths = np.sqrt(sums["sxx"]) * np.sqrt(sums["syy"])
            return np.where(lengths > 0, sums["sxy"] / lengths, np.nan)
        if kind == "pearson":
            spread = (n * sums["sxx"] - x * x) * (n * sums["syy"] - y * y)
            return np.where((n >= 2) & (spread > 0), (n * sums["sxy"] - x * y) / np.sqrt(spread), np.nan)
    raise ValueError(f"unknown similarity {kind}")


def similarities(ratings: DataFrame, asked: DataFrame, of: str, over: str, kind: str = "msd",
                 min_common: int = 1, wanted: DataFrame | None = None, k: int | None = None) -> DataFrame:
    """(a, b, sim, n): likeness of every asked ``of`` to all others with a common ``over``.

    ``ratings`` has one row per pair.  Sums run over common keys only; pearson is
    null with fewer than two of them or where a side is constant.  With ``wanted``
    only its pairs (a, b) are given, with ``k`` at least the ``k`` most alike of each
    ``a``, ties by ``b``, and no null.
    """
    left = (ratings.join(asked.select(of).distinct(), of, "left_semi")
            .select(F.col(over).alias("over"), F.col(of).alias("a"), F.col("rating").cast("double").alias("x")))
    right = ratings.select(F.col(over).alias("over"), F.col(of).alias("b"), F.col("rating").cast("double").alias("y"))
    if wanted is not None:
        left = left.join(wanted.select("a").distinct(), "a", "left_semi")
        right = right.join(wanted.select("b").distinct(), "b", "left_semi")
    rows, _, opened, _ = with_raters(left, right)

    def work(table: pa.Table) -> pa.Table:
        pairs = Pairs(opened(table))
        sums = pairs.sums(pairs.of_row("x"), pairs.of_list("y"), np.arange(len(pairs.row)))
        sim, n = likeness(kind, sums), sums["n"]
        a, b = np.divmod(pairs.keys, max(1, len(pairs.names)))
        keep = np.flatnonzero((n >= min_common) & ~(np.isnan(sim) & (k is not None)))
        if k is not None:
            keep = keep[pairs.first(a[keep], sim[keep], b[keep], k)[0]]
        return pa.table([pairs.names.take(pa.array(a[keep])), pairs.names.take(pa.array(b[keep])),
                         pa.array(sim[keep], from_pandas=True), pa.array(n[keep])], names=["a", "b", "sim", "n"])

    kind_of = dict(ratings.dtypes)[of]
    found = rows.groupBy("bucket").applyInArrow(work, f"a {kind_of}, b {kind_of}, sim double, n long")
    return found if wanted is None else found.join(wanted.select("a", "b").distinct(), ["a", "b"], "left_semi")


def nearest_raters(kind: str, k: int, opened: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """(a, over, b, sim, rating) of a bucket: the ``k`` raters most like ``a`` of everything it is asked about."""
    def work(table: pa.Table) -> pa.Table:
        table = opened(table)
        pairs = Pairs(table)
        asked, y = pairs.of_row("asked"), pairs.of_list("y")
        sim = likeness(kind, pairs.sums(pairs.of_row("x"), y, np.flatnonzero(~asked)))[pairs.key]
        at = np.flatnonzero(asked & (sim > 0))
        # the raters of one thing may come in several lists
        over, names = ranked(table["over"].combine_chunks())
        over = over[pairs.row[at]]
        _, group = np.unique(pairs.a[at] * max(1, len(names)) + over, return_inverse=True)
        keep, _ = pairs.first(group, sim[at], pairs.b[at], k)
        at, over = at[keep], over[keep]
        return pa.table([pairs.names.take(pa.array(pairs.a[at])), names.take(pa.array(over)),
                         pairs.names.take(pa.array(pairs.b[at])), pa.array(sim[at]), pa.array(y[at], from_pandas=True)],
                        names=["a", "over", "b", "sim", "rating"])
    return work


def _sides(user_based: bool) -> tuple[str, str]:
    return ("user_id", "item_id") if user_based else ("item_id", "user_id")


def nearest(train: DataFrame, asked: DataFrame, k: int = 40, kind: str = "msd", user_based: bool = True) -> DataFrame:
    """(user_id, item_id, b, sim, rating): the ``k`` most similar raters with a positive similarity, ties by id."""
    of, over = _sides(user_based)
    pairs = asked.select(of, over).distinct()
    named = [F.col(over).alias("over"), F.col(of).alias("a")]
    value = F.col("rating").cast("double")
    # the training rows of what is asked give the likeness, the asked rows the raters to choose from
    left = (train.join(pairs.select(of).distinct(), of, "left_semi").select(*named, value.alias("x"), F.lit(False).alias("asked"))
            .unionByName(pairs.select(*named, F.lit(None).cast("double").alias("x"), F.lit(True).alias("asked"))))
    rows, _, opened, _ = with_raters(left, train.select(F.col(over).alias("over"), F.col(of).alias("b"), value.alias("y")))
    types = dict(train.dtypes)
    found = (rows.groupBy("bucket").applyInArrow(nearest_raters(kind, k, opened), (
        f"a {types[of]}, over {types[over]}, b {types[of]}, sim double, rating double"))
             .withColumnsRenamed({"a": of, "over": over}))
    return top_k_per_group(found, [of, over], [F.desc("sim"), F.asc("b")], k)


def knn_predictions(train: DataFrame, asked: DataFrame, k: int = 40, kind: str = "msd", user_based: bool = True,
                    centred: bool = False, near: DataFrame | None = None) -> DataFrame:
    """The asked (user_id, item_id) rows with ``prediction``.

    The ``k`` most similar raters with a positive similarity are averaged, ties
    by id.  ``centred`` averages what they are above their own mean.  Without a
    neighbour the own mean (centred) or the mean of all ratings holds.  ``near`` is
    ``nearest`` of the same ratings and settings where it is at hand.
    """
    of, over = _sides(user_based)
    means = train.groupBy(of).agg(F.avg("rating").alias("own_mean"))
    near = nearest(train, asked, k, kind, user_based) if near is None else near
    if centred:
        near = (near.join(means.select(F.col(of).alias("b"), "own_mean"), "b")
                .withColumn("rating", F.col("rating") - F.col("own_mean")))
    drawn = near.groupBy(of, over).agg((F.sum(F.col("sim") * F.col("rating")) / F.sum("sim")).alias("_p"))
    overall = train.agg(F.avg("rating").alias("m")).scalar()
    out = asked.join(drawn, [of, over], "left")
    if centred:
        out = out.join(means, of, "left")
        base = F.coalesce("own_mean", overall)
        value = base + F.coalesce("_p", F.lit(0.0))
    else:
        value = F.coalesce("_p", overall)
    return out.withColumn("prediction", clip_rating(value)).select(*asked.columns, "prediction")


def mean_predictions(train: DataFrame, asked: DataFrame, by: str = "item_id") -> DataFrame:
    """The mean rating of the row's ``by``, else of all ratings."""
    means = train.groupBy(by).agg(F.avg("rating").alias("_m"))
    overall = train.agg(F.avg("rating").alias("m")).scalar()
    return asked.join(means, by, "left").select(*asked.columns, F.coalesce("_m", overall).alias("prediction"))


def normal_predictions(train: DataFrame, asked: DataFrame, key: Column, seed: int = 42) -> DataFrame:
    """A repeatable draw from the normal distribution of the training ratings, kept on the scale."""
    r = F.col("rating")
    stats = lambda agg: train.agg(agg.alias("v")).scalar()
    mean = stats(F.avg(r))
    spread = stats(F.sqrt(F.sum(r * r) / F.count(r) - F.avg(r) * F.avg(r)))
    u, v = (hashing.unit(hashing.draw(key, s)) for s in (seed, seed + 1))
    # Box and Muller; 1 - u is never 0
    z = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u)) * F.cos(v * F.lit(6.283185307179586))
    return asked.withColumn("prediction", clip_rating(mean + spread * z))
