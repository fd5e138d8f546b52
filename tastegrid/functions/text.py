"""Text and list expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters removed from a list held as text.
LIST_NOISE = r"[ \[\]']"
LIST_NOISE_KEEP_SPACES = r"[\[\]']"
# Characters around the id in a store URL.
URL_HEAD = 35
URL_TAIL = 16


def url_key(url: Column, head: int = URL_HEAD, tail: int = URL_TAIL) -> Column:
    """What is left of ``url`` without its first ``head`` and last ``tail`` characters."""
    kept = F.greatest(F.length(url) - F.lit(head + tail), F.lit(0))
    return F.substr(url, F.lit(head + 1), kept)


def url_number(url: Column, pattern: str = r"/(\d+)") -> Column:
    """First number after a slash, NULL when there is none."""
    return F.nullif(F.regexp_extract(url, pattern, 1), F.lit("")).cast("bigint")


def strip_list(text: Column, keep_spaces: bool = False) -> Column:
    """Drop brackets and apostrophes; spaces too unless they are to be kept."""
    return F.regexp_replace(text, LIST_NOISE_KEEP_SPACES if keep_spaces else LIST_NOISE, "")


def list_from_text(text: Column, keep_spaces: bool = False) -> Column:
    """``"['a', 'b c']"`` to an array of labels."""
    if keep_spaces:
        return F.transform(F.split(strip_list(text, True), ","), F.trim)
    return F.split(strip_list(text), ",")


def lower_text(value: Column) -> Column:
    """Lower-case text form of any value."""
    return F.lower(value.cast("string"))
