"""Bin numbers as expressions.  Bins are numbered from 1; outside is NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Price bands (left side closed) and activity bands (right side closed).
PRICE_EDGES = (0.0, 10.0, 30.0, 80.0, float("inf"))
PRICE_LABELS = ("0-10€", "10-30€", "30-80€", ">80€")
ACTIVITY_EDGES = (0.0, 2.0, 5.0, 20.0, float("inf"))
ACTIVITY_LABELS = ("1-2", "3-5", "6-20", "20+")


def cut(value: Column, edges: Sequence[float], right: bool = True) -> Column:
    """Fixed bins, closed on the right or on the left."""
    chain = None
    for number, (lo, hi) in enumerate(zip(edges, edges[1:]), start=1):
        if right:
            inside = (value > F.lit(lo)) & (value <= F.lit(hi))
        else:
            inside = (value >= F.lit(lo)) & (value < F.lit(hi))
        chain = F.when(inside, F.lit(number)) if chain is None else chain.when(inside, F.lit(number))
    return chain


def bin_label(number: Column, labels: Sequence[str]) -> Column:
    """Label of a bin number."""
    return F.try_element_at(F.array(*[F.lit(x) for x in labels]), number)


def edge_bin(value: Column, edges: Column, q: int) -> Column:
    """Bin of ``value`` among up to ``q`` + 1 rising ``edges``, right side closed,
    lowest value included.  Plain comparisons, so the projection stays compiled."""
    below = F.lit(0)
    for i in range(q + 1):
        below = below + F.coalesce((F.get(edges, F.lit(i)) < value).cast("int"), F.lit(0))
    return F.when(value.isNotNull(), F.greatest(F.lit(1), below))


def width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin; the last bin is closed, a single-valued column goes to bin 1."""
    position = F.floor((value - low) / F.nullif(high - low, F.lit(0.0)) * F.lit(float(bins)))
    return F.when(value.isNotNull(), F.least(F.lit(bins), F.coalesce(position, F.lit(0)).cast("int") + F.lit(1)))
