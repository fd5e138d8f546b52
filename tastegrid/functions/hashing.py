"""Repeatable draws: randomness comes from a key, never from row order.

A draw made from ``md5(seed:key)`` gives the same rows whatever the
partitioning, survives a lost executor and can be repeated in plain SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(key: Column, seed: int = 42) -> Column:
    """32 hex digits, uniform over keys."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def unit(hex_digest: Column) -> Column:
    """The first eight hex digits as a number in [0, 1)."""
    return F.conv(F.substr(hex_digest, F.lit(1), F.lit(8)), 16, 10).cast("double") / F.lit(float(2 ** 32))


def drawn_below(hex_digest: Column, share: float) -> Column:
    """True for ``share`` of the keys, by text comparison of the digest."""
    if share >= 1.0:
        return F.lit(True)
    return F.substr(hex_digest, F.lit(1), F.lit(8)) < F.lit(f"{int(share * 2 ** 32):08x}")


def fold(hex_digest: Column, k: int) -> Column:
    """Fold number 0..k-1."""
    whole = F.conv(F.substr(hex_digest, F.lit(1), F.lit(8)), 16, 10).cast("bigint")
    return (whole % F.lit(k)).cast("int")
