"""Memory of Python workers: what a function gave for repeated words, and what is given back after a task."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa


class Memo(dict):
    """``memo[key]`` is ``compute(key)``, kept for the last ``most`` to ``2 * most`` new keys.

    Values must not be None.
    """

    def __init__(self, compute: Callable, most: int):
        super().__init__()
        self.compute, self.most, self.old = compute, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def give_back() -> None:
    """Return freed memory to the system; allocators keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` on the batches of a task, whose memory is given back at its end: idle workers keep what they hold."""
    @functools.wraps(work)
    def run(batches: Iterator) -> Iterator:
        yield from work(batches)
        give_back()
    return run
