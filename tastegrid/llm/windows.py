"""Repeated windows of fixed length: content-chosen anchors and a count-min prefilter.

Every window of ``length`` tokens picks the smallest hash among its inner grams
as its anchor (the leftmost on ties), so equal windows pick equal anchors at the
same place.  Consecutive windows with one anchor form a run.  A window can occur
twice only if its anchor does, so counting anchors, several times fewer than
windows, bounds window counts from above.

The sketch has two rows of ``cells`` saturating counters.  Tasks send the cells
they touched, blocks of cells are merged apart from each other, and what remains
is one bit per cell, "touched twice or more": a broadcast of ``2 * cells / 8``
bytes whatever the input.  Fuller sketches only let more windows through to the
exact second pass; they lose none.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.arrays import Slices, mixed
from tastegrid.llm.memo import tidy
from tastegrid.llm.tables import LAST_ID, written

PENDING = 1_000_000  # sketch cells a task holds before it packs them
BLOCKS = 64
ROWS = 2
FAN_IN = 64  # sketches of so many tasks merge at once


@dataclass
class Runs:
    """Runs of windows: text, first and last window start, anchor place, hashes."""

    text: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    gram: np.ndarray      # hash of the anchor's gram
    whole: np.ndarray     # hash of all tokens the run's windows cover, and of the anchor's place


def anchored_runs(values: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> Runs:
    """Runs of all windows inside the texts; text i has ``values[bounds[i]:bounds[i + 1]]``."""
    n = len(values)
    empty = np.zeros(0, np.int64)
    if n < length:
        return Runs(empty, empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64))
    slices = Slices(values)
    at = np.arange(n - gram + 1)
    hashes = slices.hashed(at, at + gram)
    bits = np.uint64(int(n).bit_length())
    lowest = (hashes >> bits << bits) | at.astype(np.uint64)
    wide, span = 1, length - gram + 1
    while wide < span:  # minima over doubling spans
        step = min(wide, span - wide)
        lowest = np.minimum(lowest[:-step], lowest[step:])
        wide += step
    place = (lowest & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    text = np.searchsorted(bounds, np.arange(len(place)), side="right") - 1
    fits = np.arange(len(place)) + length <= bounds[text + 1]
    starts = np.flatnonzero(fits)
    if not len(starts):
        return Runs(empty, empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64))
    p, t = place[starts], text[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (p[1:] != p[:-1]) | (t[1:] != t[:-1])
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(starts)) - 1
    first, last, anchor = starts[heads], starts[tails], p[heads]
    second = Slices(values, 1)
    whole = mixed(second.hashed(first, last + length) + (anchor - first).astype(np.uint64))
    return Runs(t[heads], first, last, anchor, hashes[anchor], whole)


def sketch_cells(grams: np.ndarray, cells: int) -> list[np.ndarray]:
    """The cell of each hash in each row of the sketch."""
    high = mixed(grams ^ np.uint64(0x5851F42D4C957F2D))
    return [((h >> np.uint64(8)) % np.uint64(cells)).astype(np.int64) + row * cells
            for row, h in enumerate((grams, high))]


def sketch(values: DataFrame, grams: Callable[[pa.Array], Iterator[np.ndarray]], cells: int,
           least: int = 2) -> bytes:
    """Bits of the cells that all hashes together touch at least ``least`` times (1 or 2).

    ``grams`` turns the only column of ``values`` into arrays of hashes.
    """
    width = ROWS * cells // BLOCKS

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for hashes in grams(batch.column(0)):
                pending += [c.astype(np.uint32) for c in sketch_cells(hashes, cells)]
                held += 2 * len(hashes)
                if held > PENDING:
                    yield flushed(pending)
                    pending, held = [], 0
        if held:
            yield flushed(pending)

    def flushed(pending: list[np.ndarray]) -> pa.RecordBatch:
        cell, count = np.unique(np.concatenate(pending), return_counts=True)
        cut = np.searchsorted(cell, np.arange(BLOCKS + 1) * width)
        blocks, packed = [], []
        for block in range(BLOCKS):
            own, many = cell[cut[block]:cut[block + 1]], count[cut[block]:cut[block + 1]] > 1
            if len(own):
                gaps = np.diff(own, prepend=np.uint32(block * width)).astype(np.uint32) * 2 + many
                wide = gaps.max() > 0xFFFF
                raw = gaps.astype(np.uint32 if wide else np.uint16).tobytes()
                blocks.append(block)
                packed.append((b"w" if wide else b"n") + zlib.compress(raw, 1))
        task = TaskContext.get().partitionId()
        return pa.RecordBatch.from_arrays(
            [pa.array(blocks, pa.int32()), pa.array([task] * len(blocks), pa.int32()),
             pa.array(packed, pa.binary())], ["block", "task", "cells"])

    def counted(pdf: pd.DataFrame) -> tuple[np.ndarray, int]:
        block = int(pdf["block"].iloc[0])
        counts = np.zeros(width, np.uint8)
        for raw in pdf["cells"]:
            if raw[:1] == b"d":  # counts merged before
                counts = np.minimum(counts + np.frombuffer(zlib.decompress(raw[1:]), np.uint8), 2)
                continue
            gaps = np.frombuffer(zlib.decompress(raw[1:]), np.uint32 if raw[:1] == b"w" else np.uint16)
            own = np.cumsum((gaps >> 1).astype(np.int64))
            counts[own] = np.minimum(counts[own] + 1 + (gaps & 1), 2)
        return counts, block

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        counts, block = counted(pdf)
        return pd.DataFrame({"block": [block], "task": [int(pdf["task"].min())],
                             "cells": [b"d" + zlib.compress(counts.tobytes(), 1)]})

    def final(pdf: pd.DataFrame) -> pd.DataFrame:
        counts, block = counted(pdf)
        return pd.DataFrame({"block": [block], "bits": [np.packbits(counts >= least).tobytes()]})

    out = np.zeros(ROWS * cells // 8, np.uint8)
    kind = "block int, task int, cells binary"
    parts = values.mapInArrow(tidy(touched), kind)
    for level in (1, 2):
        group = F.expr(f"task div {FAN_IN ** level}").alias("_group")
        parts = parts.groupBy("block", group).applyInPandas(merged, kind)
    parts = parts.groupBy("block").applyInPandas(final, "block int, bits binary")
    for row in parts.collect():  # at most BLOCKS rows of width / 8 bytes
        at = row["block"] * width // 8
        out[at:at + width // 8] = np.frombuffer(row["bits"], np.uint8)
    return out.tobytes()


def among(bits: np.ndarray, grams: np.ndarray, cells: int) -> np.ndarray:
    """Whether the sketch holds each hash; false is certain."""
    out = np.ones(len(grams), bool)
    for cell in sketch_cells(grams, cells):
        out &= (bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1).astype(bool)
    return out


def hashed_ids(column: pa.Array) -> np.ndarray:
    return mixed(np.asarray(column.fill_null(LAST_ID).cast(pa.int64())).view(np.uint64))


def id_bits(ids: DataFrame, cells: int = 1 << 24) -> bytes:
    """Sketch of the ids in the only column: a filter of fixed size without false negatives."""
    return sketch(ids, lambda column: iter([hashed_ids(column)]), cells, least=1)


def rows_by_id(rows: DataFrame, bits, inside: bool, cells: int = 1 << 24) -> DataFrame:
    """The rows whose first column may be, or certainly is not, among the sketched ids."""
    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            yield batch.filter(pa.array(among(seen, hashed_ids(batch.column(0)), cells) == inside))

    return rows.mapInArrow(tidy(chosen), rows.schema)


def cut_by_spans(rows: DataFrame, spans: DataFrame, cut: Callable, schema: str, also: tuple[str, ...] = ()
                 ) -> DataFrame:
    """``cut`` over keyed documents and the array of their spans (start, size) to remove.

    Texts without spans are not shuffled.
    """
    kind = F.struct(F.col("start").cast("int").alias("start"), F.col("size").cast("int").alias("size"))
    per_text = written(spans.groupBy("_id", "_key").agg(F.collect_list(kind).alias("spans")), "spans")
    bits = rows.sparkSession.sparkContext.broadcast(id_bits(per_text.select("_id")))
    rows = rows.select("_id", "_key", F.col("doc_id").cast("long").alias("doc_id"), "text", *also)
    whole = rows_by_id(rows, bits, False).withColumn("spans", F.lit(None).cast(per_text.schema["spans"].dataType))
    parts = rows_by_id(rows, bits, True).join(per_text, ["_id", "_key"], "left")
    return (whole.select("doc_id", "text", "spans", *also).mapInArrow(tidy(cut), schema)
            .unionByName(parts.select("doc_id", "text", "spans", *also).mapInArrow(tidy(cut), schema)))
