"""Removal of byte strings that occur twice, by common-prefix interval trees.

Equal windows of ``length`` bytes pick equal anchors at the same place (see
``windows``), so the suffixes to compare are those that start at anchors: an
enhanced suffix array of the corpus, kept in buckets of one anchor each.  Rows of
a bucket are sorted by the bytes from the anchor on; neighbours' common prefixes
form the intervals of a tree, found by a stack scan.  In each interval the bytes
before the anchor are compared as well: where they differ, the interval is a
maximal repeat, and each of its occurrences reaches as far left as any other
member shares.  An occurrence is covered where left and right reach add up to
``length``.

Before that, runs with equal content are counted (with map-side sums): a run that
occurs twice is covered whole, and a bucket where all runs are equal needs no
tree.  Trees get each different run once, so copies never enlarge them.  Buckets
with more than ``bucket_rows`` different runs go another, exact way: their single
windows are grouped by hash.

Matches never cross texts; strings are judged on the input.  Null text is empty;
texts under ``length`` bytes lose nothing; repeated rows are occurrences like any
other.  Null doc_id counts as the largest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.arrays import Slices, lists, text_chunks
from tastegrid.llm.memo import tidy
from tastegrid.llm.tables import keyed, written
from tastegrid.llm.windows import among, anchored_runs, cut_by_spans, sketch

CELLS = 1 << 26
RUNS = "_id long, _key long, gram long, whole long, start int, lead int, piece binary"
CUT = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
CUTS = "array<struct<cut_from:int,cut_to:int>>"
GROUPS = "gram long, whole long, cut_from int, cut_to int, repeats int"


def byte_runs(rows: DataFrame, length: int, gram: int, bits, cells: int) -> DataFrame:
    """Runs whose anchor may repeat, with their bytes; the anchor is ``lead`` bytes in."""
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            for first, _, raw, offsets in text_chunks(batch.column(2)):
                r = anchored_runs(raw, offsets, length, gram)
                if not len(r.text):
                    continue
                keep = among(seen, r.gram, cells)
                if not keep.any():
                    continue
                a, b, t = r.first[keep], r.last[keep] + length, r.text[keep]
                data = raw.tobytes()
                at = pa.array(first + t)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at),
                     pa.array(r.gram[keep].view(np.int64)), pa.array(r.whole[keep].view(np.int64)),
                     pa.array((a - offsets[t]).astype(np.int32)),
                     pa.array((r.anchor[keep] - a).astype(np.int32)),
                     pa.array([data[i:j] for i, j in zip(a.tolist(), b.tolist(), strict=True)],
                              pa.binary())],
                    ["_id", "_key", "gram", "whole", "start", "lead", "piece"])

    return rows.select("_id", "_key", "text").mapInArrow(tidy(runs), RUNS)


def padded(parts: list[bytes], width: int) -> np.ndarray:
    """Byte strings as rows of a matrix, filled up with zeros."""
    return np.frombuffer(b"".join([p.ljust(width, b"\0") for p in parts]), np.uint8).reshape(-1, width)


def shared(matrix: np.ndarray, sizes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length of the common prefix of rows i and j."""
    differs = np.ones((len(i), matrix.shape[1] + 1), bool)
    np.not_equal(matrix[i], matrix[j], out=differs[:, :-1])
    return np.minimum(differs.argmax(axis=1), np.minimum(sizes[i], sizes[j]))


def intervals(common: list[int]) -> Iterator[tuple[int, int, int]]:
    """(prefix length, first, last) of every interval of a common-prefix array, children first."""
    stack = [(0, 0)]
    for at, height in enumerate([*common, -1]):
        first = at
        while stack and stack[-1][0] > height:
            top, first = stack.pop()
            if top > 0:
                yield top, first, at
        if not stack or stack[-1][0] < height:
            stack.append((height, first))


def covered(right: np.ndarray, right_size: np.ndarray, left: np.ndarray, left_size: np.ndarray,
            common: np.ndarray, length: int) -> list[tuple[int, int, int, int]]:
    """(member, bytes left, bytes right, members of the repeat) spans of one sorted bucket."""
    out = []
    order = np.lexsort(left.T[::-1]) if left.shape[1] else np.arange(len(right_size))
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    for height, first, last in intervals(common.tolist()):
        members = np.arange(first, last + 1)
        members = members[np.argsort(rank[members])]
        reach = shared(left, left_size, members[:-1], members[1:])
        best = np.zeros(len(members), np.int64)
        best[:-1] = reach
        best[1:] = np.maximum(best[1:], reach)
        for k in np.flatnonzero(best + height >= length):
            out.append((int(members[k]), int(best[k]), height, len(members)))
    return out


def repeat_spans(buckets: DataFrame, length: int) -> DataFrame:
    """Spans inside each different run that repeat in another run of its bucket.

    ``buckets`` has gram, whole, lead, piece; a bucket's rows are in one partition
    and sorted by the bytes from the anchor on.
    """
    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(4)]
            held += zip(*cols, strict=True)
            cut = len(held)
            while cut and held[cut - 1][0] == held[-1][0]:
                cut -= 1
            if cut:
                yield solved(held[:cut])
                held = held[cut:]
        if held:
            yield solved(held)

    def solved(rows: list[tuple]) -> pa.RecordBatch:
        lead = np.array([r[2] for r in rows])
        rights = [r[3][r[2]:] for r in rows]
        lefts = [r[3][:r[2]][::-1] for r in rows]
        right_size = np.array([len(x) for x in rights])
        right, left = padded(rights, length), padded(lefts, max(1, lead.max()))
        gram = np.array([r[0] for r in rows])
        same = gram[1:] == gram[:-1]
        i = np.flatnonzero(same)
        common = np.zeros(len(rows), np.int64)
        common[i] = shared(right, right_size, i, i + 1)
        heads = np.flatnonzero(np.append(True, ~same))
        ends = np.append(heads[1:], len(rows))
        found = []
        pairs = heads[ends - heads == 2]
        back = shared(left, lead, pairs, pairs + 1)
        for k in np.flatnonzero(back + common[pairs] >= length):
            for member in (pairs[k], pairs[k] + 1):
                found.append((member, back[k], common[pairs[k]], 2))
        for a, b in zip(heads.tolist(), ends.tolist(), strict=True):
            if b - a > 2:
                found += [(a + m, x, y, n) for m, x, y, n in covered(
                    right[a:b], right_size[a:b], left[a:b], lead[a:b], common[a:b - 1], length)]
        cols = [[rows[m][0] for m, *_ in found], [rows[m][1] for m, *_ in found],
                [int(lead[m] - x) for m, x, _, _ in found], [int(lead[m] + y) for m, _, y, _ in found],
                [int(n) for *_, n in found]]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                          ["gram", "whole", "cut_from", "cut_to", "repeats"])

    return buckets.mapInArrow(tidy(spans), GROUPS)


def hashed_spans(pieces: DataFrame, length: int) -> DataFrame:
    """The same spans for large buckets: every window's hash, grouped."""
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, hashes = [], []
            for piece in batch.column(2).to_pylist():
                at = np.arange(len(piece) - length + 1)
                hashes.append(Slices(np.frombuffer(piece, np.uint8)).hashed(at, at + length))
                counts.append(len(at))
            wins = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), lists(wins.view(np.int64), np.array(counts, int), pa.int64())],
                ["gram", "whole", "wins"])

    single = (pieces.select("gram", "whole", "piece")
              .mapInArrow(tidy(windows), "gram long, whole long, wins array<long>")
              .select("gram", "whole", F.posexplode("wins").alias("at", "win")))
    again = single.groupBy("gram", "win").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return (single.join(again, ["gram", "win"])
            .select("gram", "whole", F.col("at").alias("cut_from"),
                    (F.col("at") + length).alias("cut_to"), F.col("n").cast("int").alias("repeats")))


def merged(cuts: Column) -> Column:
    """The same bytes in as few (cut_from, cut_to) as can be: a run among many alike has many cuts that overlap."""
    def joined(done: Column, cut: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        longer = F.struct(last["cut_from"].alias("cut_from"), F.greatest(last["cut_to"], cut["cut_to"]).alias("cut_to"))
        return F.when(last["cut_to"] >= cut["cut_from"], F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))
                      ).otherwise(F.concat(done, F.array(cut)))

    return F.aggregate(F.array_sort(cuts), F.lit(None).cast(CUTS), lambda done, cut: F.when(
        done.isNull(), F.array(cut)).otherwise(joined(done, cut)))


def repeated_bytes(docs: DataFrame, length: int = 200, gram: int = 64, cells: int = CELLS,
                   bucket_rows: int = 2048) -> DataFrame:
    """(_id, _key, start, size) byte spans covered by strings that also start elsewhere."""
    rows = keyed(docs)

    def anchors(column: pa.Array) -> Iterator[np.ndarray]:
        for _, _, raw, offsets in text_chunks(column):
            yield anchored_runs(raw, offsets, length, gram).gram

    bits = docs.sparkSession.sparkContext.broadcast(sketch(rows.select("text"), anchors, cells))
    runs = written(byte_runs(rows, length, gram, bits, cells), "runs")
    light = runs.select("_id", "_key", "gram", "whole", "start", F.length("piece").alias("size"))
    content = light.groupBy("gram", "whole").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct("_id", "_key", "start")).alias("at"))
    whole = light.join(content.where("times > 1"), ["gram", "whole"], "left_semi").select(
        "_id", "_key", "start", "size")
    kinds = content.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    first = content.join(kinds, "gram").select("gram", "whole", "kinds", "at._id", "at._key", "at.start")
    different = written(
        runs.join(first, ["gram", "whole", "_id", "_key", "start"])
        .dropDuplicates(["gram", "whole"]).select("gram", "whole", "lead", "piece", "kinds"), "buckets")
    trees = (different.where(F.col("kinds") <= bucket_rows).repartition("gram")
             .sortWithinPartitions("gram", F.expr("substring(piece, lead + 1)"))
             .select("gram", "whole", "lead", "piece"))
    cuts = repeat_spans(trees, length).unionByName(
        hashed_spans(different.where(F.col("kinds") > bucket_rows), length))
    cuts = cuts.groupBy("gram", "whole").agg(
        merged(F.collect_set(F.struct("cut_from", "cut_to"))).alias("cuts"))  # at most one per start in a run
    edge = (light.join(cuts, ["gram", "whole"])
            .select("_id", "_key", F.explode("cuts").alias("cut"), "start")
            .select("_id", "_key", (F.col("start") + F.col("cut.cut_from")).alias("start"),
                    (F.col("cut.cut_to") - F.col("cut.cut_from")).alias("size")))
    return whole.unionByName(edge)


def removed_bytes(docs: DataFrame, length: int = 200, gram: int = 64, cells: int = CELLS,
                  bucket_rows: int = 2048, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept bytes, and the columns ``also``."""
    kinds = {f.name: f for f in docs.schema.fields}
    extra = "".join(f", {c} {kinds[c].dataType.simpleString()}" for c in also)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, spans = (batch.column(i) for i in range(3))
            out: list[list] = [[], [], [], [], []]
            for text, own in zip(texts.cast(pa.binary()), spans, strict=True):
                kept = raw = text.as_py() or b""
                n_spans = 0
                if own.is_valid and len(own.values):
                    change = np.zeros(len(raw) + 1, np.int64)
                    start = np.asarray(own.values.field("start"))
                    np.add.at(change, start, 1)
                    np.add.at(change, start + np.asarray(own.values.field("size")), -1)
                    stay = np.cumsum(change)[:-1] == 0
                    n_spans = int((~stay[1:] & stay[:-1]).sum() + (not stay[0]))
                    kept = np.frombuffer(raw, np.uint8)[stay].tobytes()
                for col, value in zip(out, (len(raw), len(raw) - len(kept), n_spans,
                                            hashlib.sha256(kept).hexdigest(), kept), strict=True):
                    col.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(c, t) for c, t in zip(out, types, strict=True)), *batch.columns[3:]],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", *also])

    spans = repeated_bytes(docs, length, gram, cells, bucket_rows)
    return cut_by_spans(keyed(docs, also=also), spans, cut, CUT + extra, also)
