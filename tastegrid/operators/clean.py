"""Projections, filters and null handling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def nan_to_null(frame: DataFrame) -> DataFrame:
    """NaN is how flat files spell a missing number; SQL spells it NULL."""
    floats = [f.name for f in frame.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    return frame.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floats}) if floats else frame


def drop_columns(frame: DataFrame, *columns: str) -> DataFrame:
    """All columns but these; the scan stops reading them."""
    return frame.drop(*columns)


def reorder(frame: DataFrame, *columns: str) -> DataFrame:
    """These columns in this order."""
    return frame.select(*columns)


def rename(frame: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """New names for some columns."""
    return frame.withColumnsRenamed(dict(names))


def recast(frame: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns; text that does not parse becomes NULL rather than failing the job."""
    kinds = dict(frame.dtypes)
    return frame.withColumns({
        c: F.col(c).try_cast(t) if kinds[c] == "string" else F.col(c).cast(t)
        for c, t in types.items()})


def shift(frame: DataFrame, columns: Sequence[str], by: float = 1e-6) -> DataFrame:
    """Add a constant to some columns, e.g. so that scaled zeros count as present."""
    return frame.withColumns({c: F.col(c) + F.lit(by) for c in columns})


def rescale(frame: DataFrame, column: str, offset: float, width: float) -> DataFrame:
    """``(column + offset) / width``."""
    return frame.withColumn(column, (F.col(column) + F.lit(offset)) / F.lit(width))


def keyed(frame: DataFrame, key: Column, name: str) -> DataFrame:
    """Put a computed key first; it stays an ordinary column."""
    rest = [c for c in frame.columns if c != name]
    return frame.select(key.alias(name), *rest)


def keep_flagged(frame: DataFrame, flag: str) -> DataFrame:
    """Rows whose flag is true; false and NULL go."""
    return frame.where(F.col(flag))


def drop_nulls(frame: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in ``subset``, or anywhere."""
    return frame.na.drop(subset=list(subset) if subset else None)


def drop_empty_lists(frame: DataFrame, column: str) -> DataFrame:
    """Keep rows whose list has an element; a list held as text is empty when it reads ``[]``."""
    if dict(frame.dtypes)[column] == "string":
        return frame.where(F.length(column) != 2)
    return frame.where(F.size(column) > 0)


def fill_nulls(frame: DataFrame, value: object, subset: Sequence[str] | None = None) -> DataFrame:
    """Replace NULL by a constant in columns of the constant's type."""
    return frame.na.fill(value, subset=list(subset) if subset else None)


def null_mask(frame: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """True where a value is present."""
    masks = [F.col(c).isNotNull().alias(c) for c in frame.columns if c not in keep]
    return frame.select(*keep, *masks)


def null_profile(frame: DataFrame) -> DataFrame:
    """One row per column: number and share of NULLs, in one pass."""
    counts = frame.agg(F.count(F.lit(1)).alias("_rows"),
                       *[F.count_if(F.col(c).isNull()).alias(c) for c in frame.columns])
    rows = [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls"),
                     F.try_divide(F.col(c), F.col("_rows")).alias("share")) for c in frame.columns]
    return counts.select(F.inline(F.array(*rows)))
