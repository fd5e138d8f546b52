"""Tables in the shared folder: cut lineage, rounds of an iteration, saved models.

What a round reads is a finished table, so a lost executor repeats tasks of one
round only.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tastegrid.session import scratch_path

LAYOUT = 1


def written(df: DataFrame, name: str, parts: int | None = None) -> DataFrame:
    """The rows as a table in the shared folder, computed once."""
    return _at(df, scratch_path(df.sparkSession, name), parts)


def _at(df: DataFrame, path: str, parts: int | None = None) -> DataFrame:
    (df if parts is None else df.coalesce(parts)).write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Rounds:
    """Tables of an iteration; those of the round before last are removed when a round is done."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.paths = spark, name, []

    def done(self, **tables: DataFrame) -> list[DataFrame]:
        """Write the tables of a round; the two last rounds stay."""
        root = scratch_path(self.spark, self.name)
        out = [_at(df, f"{root}/{name}") for name, df in tables.items()]
        self.paths.append(root)
        if len(self.paths) > 2:
            remove(self.spark, self.paths.pop(0))
        return out


def _folder(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table of this package's own making."""
    system, where = _folder(spark, path)
    system.delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _folder(spark, path)
    return system.exists(where)


def save(path: str, tables: Mapping[str, DataFrame], **facts: object) -> None:
    """Write named tables, and last a row that says they are whole: layout, schemas and ``facts``."""
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    about = {"layout": LAYOUT, "tables": {n: df.schema.json() for n, df in tables.items()}, "facts": facts}
    spark.createDataFrame([(json.dumps(about),)], "about string").coalesce(1).write.mode("overwrite").text(f"{path}/about")


def load(spark: SparkSession, path: str) -> tuple[dict[str, DataFrame], dict]:
    """The tables and facts that ``save`` wrote; an unknown layout or changed schema is an error."""
    about = json.loads(spark.read.text(f"{path}/about").first()[0])
    if about["layout"] != LAYOUT:
        raise ValueError(f"layout {about['layout']} of {path} is not {LAYOUT}")
    tables = {n: spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(f"{path}/{n}")
              for n, schema in about["tables"].items()}
    for name, df in tables.items():
        found = spark.read.parquet(f"{path}/{name}")
        if sorted(found.dtypes) != sorted(df.dtypes):
            raise ValueError(f"table {name} of {path} has another schema than was saved")
    return tables, about["facts"]
