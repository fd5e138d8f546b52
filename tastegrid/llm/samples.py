"""Bounded samples of labelled documents for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIT_ROWS = 20_000


def remainder(doc: str, parts: int) -> Column:
    """crc32 of the doc_id as text, modulo ``parts``."""
    return F.pmod(F.crc32(F.col(doc).cast("string").cast("binary")), F.lit(parts))


def held_out(doc: str, parts: int, fold: int) -> Column:
    """Whether a document's remainder is ``fold``; a null id is not held out."""
    return F.coalesce(remainder(doc, parts) == fold, F.lit(False))


def fit_sample(docs: DataFrame, labels: DataFrame, label: str, parts: int, fold: int,
               most: int = FIT_ROWS) -> DataFrame:
    """doc_id, text, y of at most ``most`` labelled rows outside the held-out fold.

    Which rows is decided by a hash of the id.  The chosen ids are broadcast:
    ``most`` pairs of numbers.
    """
    usable = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()
                           & ~held_out("doc_id", parts, fold))
              .groupBy("doc_id").agg(F.max(label).cast("int").alias("y")))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(chosen), "doc_id"))
