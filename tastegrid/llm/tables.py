"""Small DataFrame helpers of the operators in this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tastegrid.session import checkpoint_root, scratch_path

LAST_ID = 2**63 - 1


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, safe when executors are lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed(df: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text, _id, _key) and the columns ``also``: null text is empty, and null doc_id counts as the largest.

    ``_key`` tells rows apart that share a doc_id but not a text.
    """
    text_col = F.coalesce(F.col("text"), F.lit(""))
    return df.select(F.col("doc_id"), text_col.alias("text"),
                     F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("_id"),
                     F.xxhash64(text_col).alias("_key"), *also)


def slots(df: DataFrame, group: str, spread: Column, order: list[Column], name: str,
          parts: int = 4096) -> DataFrame:
    """Add ``name``: a gapless number from 0 within each ``group``.

    No task holds a whole group: rows are ranked within ``parts`` slices of it,
    told by the hash ``spread``, and the slices' counts are summed up before them.
    Rows with equal ``spread`` and ``order`` may swap numbers.
    """
    cut = df.withColumn("_slice", F.pmod(spread, F.lit(parts)).cast("int"))
    counts = cut.groupBy(group, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(group, "_slice", (F.sum("_n").over(
        Window.partitionBy(group).orderBy("_slice")) - F.col("_n")).alias("_before"))
    rank = F.row_number().over(Window.partitionBy(group, "_slice").orderBy(*order))
    return (cut.withColumn("_rank", rank).join(before, [group, "_slice"])
            .withColumn(name, (F.col("_before") + F.col("_rank") - 1).cast("long"))
            .drop("_slice", "_rank", "_before"))


__all__ = ["LAST_ID", "checkpoint_root", "conversations", "documents", "keyed", "labels", "slots", "written"]
