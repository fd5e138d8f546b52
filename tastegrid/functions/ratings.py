"""Expressions on ratings and review labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tastegrid.functions.text import lower_text

# Review labels and their order.
REVIEW_LABELS = {
    "overwhelmingly negative": -4,
    "very negative": -3,
    "mostly negative": -2,
    "negative": -1,
    "mixed": 0,
    "positive": 1,
    "mostly positive": 2,
    "very positive": 3,
    "overwhelmingly positive": 4,
}
# Rating scale and the chance of the first of the two ratings.
SCALE_LOW, SCALE_HIGH = 1.0, 5.0
CHANCE_OF_FOUR = 0.3
CHANCE_OF_ONE = 0.7


def label_score(label: Column) -> Column:
    """Review label to -4..4; an unknown label gives NULL."""
    pairs = [F.lit(x) for item in REVIEW_LABELS.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), lower_text(label))


def label_share(score: Column) -> Column:
    """-4..4 to 0..1."""
    return (score + F.lit(4)) / F.lit(8.0)


def stars_from_flag(flag: Column, u: Column) -> Column:
    """Liked: 4 or 5; not liked (or unknown): 1 or 2; ``u`` is uniform in [0, 1)."""
    liked = F.when(u < CHANCE_OF_FOUR, F.lit(4)).otherwise(F.lit(5))
    disliked = F.when(u < CHANCE_OF_ONE, F.lit(1)).otherwise(F.lit(2))
    return F.when(lower_text(flag) == "true", liked).otherwise(disliked)


def stars_uniform(flag: Column, u: Column) -> Column:
    """Liked: 3, 4 or 5 alike; not liked: 1 or 2 alike."""
    liked = F.lit(3) + F.floor(u * F.lit(3.0))
    disliked = F.lit(1) + F.floor(u * F.lit(2.0))
    return F.when(lower_text(flag) == "true", liked).otherwise(disliked).cast("int")


def clip_rating(value: Column, low: float = SCALE_LOW, high: float = SCALE_HIGH) -> Column:
    """Keep a prediction on the rating scale; NULL stays NULL."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))
