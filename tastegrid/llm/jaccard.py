"""Self join of documents by Jaccard similarity of their word n-gram sets, and its groups.

1. Texts become sorted arrays of 64-bit shingle hashes.  Equal sets collapse to
   one, with the smallest document id, so exact copies cost one row.
2. Two sets with similarity t or more share one of their first
   ``n - ceil(t n) + 1`` shingles in any common order.  Shingles are ordered by
   how often they occur in all texts (a merged count sketch of fixed size), so
   these prefixes hold the rarest ones.  Sets that share a prefix shingle form a
   tile; tiles are banded by set size, because linked sets are in the same or
   neighbouring bands.  A tile larger than ``tile_rows`` is split by hash.
3. In every part of a tile each set is tried against the one before it in size
   and against the part's hub, the set in most tiles; links found so connect most
   of a group at a cost in proportion to its size.
4. Then only sets of a tile that are in different components are compared.  Each
   carries a bitmap of hashed shingles: bits that differ bound the overlap from
   above.  Bitmaps of fixed width say little of long texts, so sets of more
   shingles than bits have a second one of a bit or more per shingle, compared
   once per pair.  Pairs within the bounds are checked by exact sorted-array
   intersection.  Any link between components passes this step, so components are
   exact.

Documents without words have an empty set, and are linked with nothing.  Null
text is empty; a null doc_id gives a null id and takes no part in links.
Repeated rows give one row each; rows that share a doc_id but not a text are
documents of their own with one id.  Sets are told apart by 64-bit hashes, as
shingles are: among 10^9 different sets two coincide with a chance of 3 %, and
would then count as one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastegrid.llm.arrays import Slices, lists, mixed, text_chunks, word_hashes
from tastegrid.llm.components import components
from tastegrid.llm.memo import tidy
from tastegrid.llm.tables import written
from tastegrid.llm.windows import among, hashed_ids, id_bits, rows_by_id, sketch

SKETCH_BITS = 18
TILE_CELLS = 1 << 25
WORDS = 32  # 64-bit words of a bitmap
FAN_IN = 64


def shingle_sets(column: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, sorted distinct shingle hashes of all texts of a chunk, set sizes)."""
    for first, _, raw, offsets in text_chunks(column):
        words, bounds = word_hashes(raw, offsets, lower=True)
        count = np.diff(bounds)
        size = np.where(count >= n, count - n + 1, np.minimum(count, 1))
        text = np.repeat(np.arange(len(count)), size)
        start = bounds[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(size) - size, size)
        hashes = Slices(words).hashed(start, np.minimum(start + n, bounds[text + 1]))
        order = np.lexsort((hashes, text))
        hashes, text = hashes[order], text[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
        yield first, hashes[new], np.bincount(text[new], minlength=len(count))


def frequencies(docs: DataFrame, n: int) -> np.ndarray:
    """Counts of all texts' shingles in ``2 ** SKETCH_BITS`` cells: fixed size, all data."""
    cells, shift = 1 << SKETCH_BITS, np.uint64(64 - SKETCH_BITS)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(cells, np.uint32)
        for batch in batches:
            for _, hashes, _ in shingle_sets(batch.column(0), n):
                counts += np.bincount((hashes >> shift).astype(np.int64), minlength=cells).astype(np.uint32)
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int32()),
             pa.array([zlib.compress(counts.tobytes(), 1)], pa.binary())], ["task", "counts"])

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(cells, np.uint32)
        for raw in pdf["counts"]:
            total += np.frombuffer(zlib.decompress(raw), np.uint32)
        return pd.DataFrame({"task": [int(pdf["task"].min())],
                             "counts": [zlib.compress(total.tobytes(), 1)]})

    parts = docs.select("text").mapInArrow(tidy(counted), "task int, counts binary")
    for level in (1, 2, 5):  # the last takes every task there can be
        parts = parts.groupBy(F.expr(f"task div {FAN_IN ** level}L").alias("_g")).applyInPandas(
            merged, "task int, counts binary")
    rows = parts.collect()  # one row of at most 4 * 2 ** SKETCH_BITS bytes
    return np.frombuffer(zlib.decompress(rows[0]["counts"]), np.uint32) if rows else np.zeros(cells, np.uint32)


def wide_bitmaps(codes: np.ndarray, heads: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Bitmaps of a power of two bits, as many as shingles or more; empty where the narrow one does."""
    parts, words = [], np.zeros(len(heads), np.int64)
    for i in np.flatnonzero(ends - heads > WORDS * 64):
        width = 1 << int(ends[i] - heads[i] - 1).bit_length()
        bitmap = np.zeros(width, np.uint8)
        bitmap[(codes[heads[i]:ends[i]] % np.uint64(width)).astype(np.int64)] = 1
        parts.append(np.packbits(bitmap).view(np.int64))
        words[i] = width // 64
    return lists(np.concatenate(parts) if parts else np.zeros(0, np.int64), words, pa.int64())


def signed_sets(docs: DataFrame, n: int, percent: int, order) -> DataFrame:
    """doc_id, n_shingles, hash of the set, prefix shingles and bitmaps of every text."""
    shift = np.uint64(64 - SKETCH_BITS)
    kind = ("doc_id long, text_key long, n_shingles long, set_a long, prefix array<long>, bits array<long>, "
            "wide array<long>")

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.frombuffer(order.value, np.uint32)
        for batch in batches:
            for first, hashes, sizes in shingle_sets(batch.column(1), n):
                text = np.repeat(np.arange(len(sizes)), sizes)
                ends = np.cumsum(sizes)
                heads = ends - sizes
                codes = mixed(hashes)
                rank = np.lexsort((hashes, counts[(hashes >> shift).astype(np.int64)], text))
                keep = np.where(sizes > 0, sizes - (sizes * percent + 99) // 100 + 1, 0)
                place = np.arange(len(hashes)) - np.repeat(heads, sizes)
                prefix = hashes[rank][place < np.repeat(keep, sizes)]
                bitmap = np.zeros(len(sizes) * WORDS * 64, np.uint8)
                bitmap[text * (WORDS * 64) + (codes % np.uint64(WORDS * 64)).astype(np.int64)] = 1
                bits = np.packbits(bitmap).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(sizes)), batch.column(2).slice(first, len(sizes)),
                     pa.array(sizes, pa.int64()),
                     pa.array(Slices(hashes).hashed(heads, ends).view(np.int64)),
                     lists(prefix.view(np.int64), keep, pa.int64()),
                     lists(bits, np.full(len(sizes), WORDS), pa.int64()), wide_bitmaps(codes, heads, ends)],
                    ["doc_id", "text_key", "n_shingles", "set_a", "prefix", "bits", "wide"])

    text_key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    return docs.select(F.col("doc_id").cast("long"), "text", text_key).mapInArrow(tidy(signed), kind)


def postings(sets: DataFrame, percent: int) -> DataFrame:
    """tile, id, n, short of the prefix shingles that may occur in two sets or more.

    ``short``: the shingle is among the first ``n - ceil(2 t n / (1 + t)) + 1``.
    That is prefix enough for the smaller set of a linked pair, whose sets share
    2 t / (1 + t) of the smaller size at least.
    """
    bits = sets.sparkSession.sparkContext.broadcast(sketch(
        sets.select("prefix"), lambda c: iter([np.asarray(c.flatten()).view(np.uint64)]), TILE_CELLS))

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            values = np.asarray(batch.column(2).flatten())
            count = np.asarray(pc.list_value_length(batch.column(2)))
            row = np.repeat(np.arange(batch.num_rows), count)
            size = np.asarray(batch.column(1))
            first = size - (2 * percent * size + 99 + percent) // (100 + percent) + 1
            place = np.arange(len(values)) - np.repeat(np.cumsum(count) - count, count)
            keep = among(seen, values.view(np.uint64), TILE_CELLS)
            rows = pa.array(row[keep])
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[keep]), batch.column(0).take(rows), batch.column(1).take(rows),
                 pa.array((place < first[row])[keep])], ["tile", "id", "n", "short"])

    return sets.where("n_shingles > 0 and doc_id is not null").select(
        F.col("set_a").alias("id"), "n_shingles", "prefix").mapInArrow(
        tidy(shared), "tile long, id long, n long, short boolean")


def set_arrays(docs: DataFrame, pairs: DataFrame, same: DataFrame, n: int) -> DataFrame:
    """id and the sorted shingle hashes, as bytes, of the sets in pairs (and a few others).

    Only texts of the sets' smallest documents are parted into shingles again.
    """
    context = docs.sparkSession.sparkContext
    ids = written(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(same, "id"), "asked")
    bits = context.broadcast(id_bits(ids.select("id")))
    heads = context.broadcast(id_bits(ids.select("head")))

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            for _, hashes, sizes in shingle_sets(batch.column(1), n):
                cut = np.concatenate([[0], np.cumsum(sizes)])
                ids = pa.array(Slices(hashes).hashed(cut[:-1], cut[1:]).view(np.int64))
                rows = np.flatnonzero(among(seen, hashed_ids(ids), 1 << 24) & (sizes > 0))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(rows)),
                     pa.array([hashes[cut[i]:cut[i + 1]].tobytes() for i in rows], pa.binary())],
                    ["id", "shingles"])

    rows = rows_by_id(docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text"), heads, True)
    return rows.mapInArrow(tidy(arrays), "id long, shingles binary")


def linked(docs: DataFrame, pairs: DataFrame, same: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets overlap enough, by sorted-array intersection."""
    pairs = written(pairs, "pairs")
    arrays = set_arrays(docs, pairs, same, n).dropDuplicates(["id"])

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                both = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(
                pa.array(keep, pa.bool_()))

    left = arrays.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    right = arrays.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(
        tidy(checked), "a long, b long")


def close(percent: int) -> F.Column:
    """Bound on the overlap of rows l and r: sizes, and bits that differ."""
    apart = sum((F.bit_count(F.expr(f"l.bits[{i}] ^ r.bits[{i}]")) for i in range(WORDS)), F.lit(0))
    total = F.col("l.n") + F.col("r.n")
    # twice the overlap is at most total - apart, and must be 2 t / (1 + t) of total
    return (F.least("l.n", "r.n") * 100 >= F.greatest("l.n", "r.n") * percent) & (
        (total - apart) * (100 + percent) >= total * 2 * percent)


def close_when_wide(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that wide bitmaps, where both sides have them, don't rule out."""
    wide = (sets.where(F.size("wide") > 0).select(F.col("set_a").alias("id"), F.col("n_shingles").alias("n"), "wide")
            .dropDuplicates(["id"]))
    rows = (pairs.join(wide.select(F.col("id").alias("a"), F.col("n").alias("nx"), F.col("wide").alias("x")),
                       "a", "left")
            .join(wide.select(F.col("id").alias("b"), F.col("n").alias("ny"), F.col("wide").alias("y")),
                  "b", "left"))
    # a bitmap folded in half is the bitmap of half the bits
    for one, other in (("x", "y"), ("y", "x")):
        rows = rows.withColumn(one, F.expr(
            f"if(size({one}) = 2 * size({other}), zip_with(slice({one}, 1, size({other})), "
            f"slice({one}, size({other}) + 1, size({other})), (p, q) -> p | q), {one})"))
    apart = F.expr("aggregate(zip_with(x, y, (p, q) -> bit_count(p ^ q)), 0, (s, v) -> s + v)")
    total = F.col("nx") + F.col("ny")
    within = (total - apart) * (100 + percent) >= total * 2 * percent
    return rows.where((F.size("x") != F.size("y")) | F.coalesce(within, F.lit(True))).select("a", "b")


def jaccard_groups(docs: DataFrame, n: int = 4, percent: int = 85, tile_rows: int = 4096) -> DataFrame:
    """doc_id, n_shingles, component_id, text_key, group_id of every document; links have similarity ``percent`` or more.

    ``text_key`` tells rows apart that share a doc_id, ``group_id`` names the
    component and is null for rows that take no part in links.
    """
    spark = docs.sparkSession
    order = spark.sparkContext.broadcast(frequencies(docs, n).tobytes())
    sets = written(signed_sets(docs, n, percent, order), "sets")
    named_sets = sets.where("n_shingles > 0 and doc_id is not null")
    same = written(named_sets.groupBy(F.col("set_a").alias("id"))
                   .agg(F.min("doc_id").alias("head")), "same")
    band = F.floor(F.log("n") / F.log(F.lit(100 / percent))).cast("int")
    # dealt by tile once, for the distinct rows and their number
    found = (postings(sets, percent).repartition("tile").distinct()
             .withColumn("rows", F.count(F.lit(1)).over(Window.partitionBy("tile"))).where("rows > 1"))
    # a group's source shares more of its prefix than copies with edits of their own
    degree = Window.partitionBy("id")
    tiles = written(found.withColumn("band", band).withColumn(
        "part", F.pmod(F.xxhash64("id"), F.ceil(F.col("rows") / tile_rows)).cast("int"))
        .withColumn("degree", F.count(F.lit(1)).over(degree)), "tiles")

    by_size = Window.partitionBy("tile", "part").orderBy("n", "id")
    in_part = Window.partitionBy("tile", "part")
    hub = F.max_by(F.struct("n", "id"), F.struct("degree", "id")).over(in_part)
    tried = tiles.select("id", "n", F.lag(F.struct("n", "id")).over(by_size).alias("p"), hub.alias("q"))
    tried = (tried.select("id", "n", F.explode(F.array("p", "q")).alias("o"))
             .where(F.col("o").isNotNull() & (F.col("o.id") != F.col("id"))
                    & (F.least("o.n", "n") * 100 >= F.greatest("o.n", "n") * percent))
             .select(F.least("id", "o.id").alias("a"), F.greatest("id", "o.id").alias("b"))
             .distinct())
    bits = named_sets.select(F.col("set_a").alias("id"), F.col("n_shingles").alias("n"), "bits").dropDuplicates(["id"])
    fits = (tried.join(bits.alias("l"), F.col("a") == F.col("l.id"))
            .join(bits.alias("r"), F.col("b") == F.col("r.id"))
            .where(close(percent)).select("a", "b"))
    links = written(linked(docs, close_when_wide(fits, sets, percent), same, n, percent), "links")
    groups = components(links)

    # linked sets are in the same or the next band: those that meet in a band with one component are done
    meeting = Window.partitionBy("tile", "meet")
    next_too = F.explode(F.array("band", F.col("band") + 1)).alias("meet")
    open_rows = written(
        tiles.join(groups, "id", "left")
        .select("tile", "id", "n", "short", "band", "part", "rows", F.coalesce("component", "id").alias("component"))
        .repartition("tile").select("*", next_too)
        .withColumns({"lo": F.min("component").over(meeting), "hi": F.max("component").over(meeting),
                      "top": F.max("band").over(meeting)})
        .where("lo < hi and top = meet").drop("n", "lo", "hi", "top"), "open")
    open_rows = open_rows.join(bits, "id")
    # parts of a split tile meet pairwise; the smaller set of a pair needs its short prefix only
    pairs = F.expr("sequence(0, cast(ceil(rows / {0}) as int) - 1)".format(tile_rows))
    low = open_rows.where("short").select("*", F.explode(pairs).alias("other"))
    high = open_rows.where("band = meet").withColumn("other", F.col("part"))
    more = (low.alias("l").join(high.alias("r"), (F.col("l.tile") == F.col("r.tile"))
                                & (F.col("l.meet") == F.col("r.meet")) & (F.col("l.other") == F.col("r.other"))
                                & (F.col("l.component") != F.col("r.component"))
                                & ((F.col("l.n") < F.col("r.n"))
                                   | ((F.col("l.n") == F.col("r.n")) & (F.col("l.id") < F.col("r.id"))))
                                & close(percent))
            .select(F.least("l.id", "r.id").alias("a"), F.greatest("l.id", "r.id").alias("b"))
            .distinct())
    late = written(linked(docs, close_when_wide(more, sets, percent), same, n, percent), "links")
    groups = components(groups.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(late))
    least = same.join(groups, "id").groupBy("component").agg(F.min("head").alias("least"))
    heads = (same.join(groups, "id", "left").join(least, "component", "left")
             .select("id", F.coalesce("least", "head").alias("_least"), F.coalesce("component", "id").alias("group_id")))
    return (sets.select("doc_id", "text_key", "n_shingles", F.when(
                (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("set_a")).alias("id"))
            .join(heads, "id", "left")
            .select("doc_id", "n_shingles", F.coalesce("_least", "doc_id").alias("component_id"), "text_key",
                    "group_id"))
