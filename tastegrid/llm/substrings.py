"""Removal of repeated word windows, keeping each window's first occurrence.

A count-min sketch of all windows' anchors comes first (see ``windows``); the
second pass groups exactly the runs of windows whose anchor the sketch counts at
least twice.  A run whose whole content also occurs in an earlier document goes
as one.  Only where one anchor stands in different runs, at the edges of repeats,
are single windows grouped.  Groups are reduced before they are shuffled to the
smallest document id, so a window found everywhere stays a single row per task.

"Earlier" is a smaller doc_id, or an earlier start in the same document; null
doc_id counts as the largest.  Rows that share doc_id and text are one document
and get equal results.  Null text and texts under 20 words lose nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.arrays import Slices, lists, text_chunks, word_hashes
from tastegrid.llm.memo import tidy
from tastegrid.llm.tables import keyed, written
from tastegrid.llm.windows import among, anchored_runs, cut_by_spans, sketch

CELLS = 1 << 26
EDGE_CELLS = 1 << 25
RUNS = "_id long, _key long, gram long, whole long, start int, n int, own array<int>"
WINDOWS = "_id long, _key long, gram long, whole long, start int, wins array<long>"
CUT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def word_runs(rows: DataFrame, window: int, gram: int, bits, cells: int, with_windows: bool) -> DataFrame:
    """Runs whose anchor is in the sketch ``bits``.

    They come with the hash of each window, or else with the places ``own`` of
    windows that start earlier in the same text already.
    """
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            for first, _, raw, offsets in text_chunks(batch.column(2)):
                words, bounds = word_hashes(raw, offsets)
                r = anchored_runs(words, bounds, window, gram)
                keep = among(seen, r.gram, cells)
                if not keep.any():
                    continue
                a, b, t = r.first[keep], r.last[keep], r.text[keep]
                count = b - a + 1
                at = np.repeat(a - np.cumsum(count) + count, count) + np.arange(count.sum())
                hashes = Slices(words, 1).hashed(at, at + window)
                texts = pa.array(first + t)
                cols = [batch.column(0).take(texts), batch.column(1).take(texts),
                        pa.array(r.gram[keep].view(np.int64)), pa.array(r.whole[keep].view(np.int64)),
                        pa.array((a - bounds[t]).astype(np.int32))]
                if with_windows:
                    yield pa.RecordBatch.from_arrays(
                        [*cols, lists(hashes.view(np.int64), count, pa.int64())],
                        ["_id", "_key", "gram", "whole", "start", "wins"])
                    continue
                of = np.repeat(np.arange(len(t)), count)
                order = np.lexsort((at, hashes, t[of]))
                same = ((hashes[order][1:] == hashes[order][:-1])
                        & (t[of[order[1:]]] == t[of[order[:-1]]]))
                again = np.sort(order[1:][same])
                yield pa.RecordBatch.from_arrays(
                    [*cols, pa.array(count.astype(np.int32)),
                     lists((at[again] - a[of[again]]).astype(np.int32),
                           np.bincount(of[again], minlength=len(t)), pa.int32())],
                    ["_id", "_key", "gram", "whole", "start", "n", "own"])

    return rows.select("_id", "_key", "text").mapInArrow(tidy(runs), WINDOWS if with_windows else RUNS)


def repeated_windows(docs: DataFrame, window: int = 20, gram: int = 6, cells: int = CELLS) -> DataFrame:
    """(_id, _key, start, size) word spans of the windows that also start earlier."""
    rows = keyed(docs)
    context = docs.sparkSession.sparkContext

    def anchors(column: pa.Array) -> Iterator[np.ndarray]:
        for _, _, raw, offsets in text_chunks(column):
            words, bounds = word_hashes(raw, offsets)
            yield anchored_runs(words, bounds, window, gram).gram

    bits = context.broadcast(sketch(rows.select("text"), anchors, cells))
    runs = written(word_runs(rows, window, gram, bits, cells, False), "runs")
    earliest = written(runs.groupBy("gram", "whole").agg(F.min("_id").alias("_first")), "earliest")
    whole = (runs.select("_id", "_key", "gram", "whole", "start", "n").join(earliest, ["gram", "whole"])
             .where("_id > _first")
             .select("_id", "_key", "start", (F.col("n") + window - 1).alias("size")))
    own = runs.select("_id", "_key", F.explode("own").alias("at"), "start").select(
        "_id", "_key", (F.col("start") + F.col("at")).alias("start"), F.lit(window).alias("size"))

    # single windows, only of anchors that stand in different runs
    edges = earliest.groupBy("gram").agg(F.count(F.lit(1)).alias("runs")).where("runs > 1").select("gram")
    edge_bits = context.broadcast(sketch(
        edges, lambda c: iter([c.to_numpy(zero_copy_only=False).view(np.uint64)]), EDGE_CELLS, least=1))
    single = (word_runs(rows, window, gram, edge_bits, EDGE_CELLS, True)
              .join(earliest.withColumnRenamed("_first", "_id"), ["gram", "whole", "_id"], "left_semi")
              .select("_id", "_key", "gram", F.posexplode("wins").alias("at", "win"), "start"))
    first = single.groupBy("gram", "win").agg(F.min("_id").alias("_first"),
                                              F.max("_id").alias("_last")).where("_first < _last")
    edge = (single.join(first, ["gram", "win"]).where("_id > _first")
            .select("_id", "_key", (F.col("start") + F.col("at")).alias("start"),
                    F.lit(window).alias("size")))
    return whole.unionByName(own).unionByName(edge)


def removed_windows(docs: DataFrame, window: int = 20, gram: int = 6, cells: int = CELLS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept: each text without its repeated words."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, spans = (batch.column(i) for i in range(3))
            out: list[list] = [[], [], [], []]
            for text, own in zip(texts.cast(pa.binary()), spans, strict=True):
                words = (text.as_py() or b"").split()
                gone = 0
                if own.is_valid and len(own.values):
                    change = np.zeros(len(words) + 1, np.int64)
                    start = np.asarray(own.values.field("start"))
                    np.add.at(change, start, 1)
                    np.add.at(change, start + np.asarray(own.values.field("size")), -1)
                    stay = np.cumsum(change)[:-1] == 0
                    gone = len(words) - int(stay.sum())
                    kept = b" ".join([words[i] for i in np.flatnonzero(stay)])
                else:
                    kept = b" ".join(words)
                for col, value in zip(out, (len(words), gone, hashlib.sha256(kept).hexdigest(),
                                            kept.decode()), strict=True):
                    col.append(value)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                 pa.array(out[2], pa.string()), pa.array(out[3], pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    spans = repeated_windows(docs, window, gram, cells)
    return cut_by_spans(keyed(docs), spans, cut, CUT)
