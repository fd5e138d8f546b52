"""Hashing of words and bytes over Arrow text batches with numpy.

A batch is cut into chunks of whole texts, and all texts of a chunk are hashed
together: a polynomial prefix sum modulo 2**64 gives the hash of any slice of
bytes or words by one subtraction and one multiplication.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18  # the work holds many arrays per byte
WHITE = np.zeros(256, dtype=bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so each has an inverse modulo 2**64
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of a base and of its inverse modulo 2**64."""
    have = _POWERS.get(which)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, CHUNK_BYTES)
        out = []
        for base in (BASES[which], pow(BASES[which], -1, 1 << 64)):
            a = np.full(size + 1, base, dtype=np.uint64)
            a[0] = 1
            out.append(np.multiply.accumulate(a))
        have = (out[0], out[1])
        if n <= 4 * CHUNK_BYTES:  # a single huge text does not stay in memory
            _POWERS[which] = have
    return have


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class Slices:
    """Hashes of slices of one sequence of unsigned integers."""

    def __init__(self, values: np.ndarray, which: int = 0):
        self.up, self.down = powers(len(values), which)
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * self.up[:len(values)], out=self.sums[1:])

    def hashed(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start]
                     + (end - start).astype(np.uint64))


def text_chunks(column: pa.Array, most: int = CHUNK_BYTES
                ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of the rows' texts in the bytes); null is empty."""
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    column = column.fill_null("")
    if not len(column):
        return
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, dtype=width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        end = min(len(column), max(first + 1, end))
        yield first, end, raw[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of every word, and each text's first word (one more at the end)."""
    n = len(raw)
    white = np.ones(n + 2, dtype=bool)
    white[1:-1] = WHITE[raw]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    inside = ~white
    starts = np.flatnonzero(inside[1:-1] & (white[:-2] | cut[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (white[2:] | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, offsets: np.ndarray, lower: bool = False
                ) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, and each text's first word (one more at the end)."""
    starts, ends, firsts = word_spans(raw, offsets)
    return Slices(LOWER[raw] if lower else raw).hashed(starts, ends), firsts


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column with ``counts[i]`` of ``values`` in row i."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
