"""File scans and sinks.

CSV and JSON are read with a declared schema, so a scan is one pass with no
inference job, and column pruning reaches the parser.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tastegrid.operators.clean import nan_to_null


def read_csv(spark: SparkSession, path: str, schema: StructType, sep: str = ",",
             quoted_newlines: bool = False) -> DataFrame:
    """CSV with a header; NaN becomes NULL, a field that does not parse becomes NULL.

    With ``quoted_newlines`` a quoted field may hold line ends; a file is then read
    by one task, so keep such files small.  A header that differs from the schema
    is an error.
    """
    return nan_to_null(_csv(spark, path, schema, sep, quoted_newlines))


def _csv(spark: SparkSession, path: str, schema: StructType, sep: str, quoted_newlines: bool) -> DataFrame:
    return (spark.read.schema(schema).option("header", True).option("sep", sep).option("multiLine", quoted_newlines)
            .option("enforceSchema", False).option("escape", '"').option("mode", "PERMISSIVE").csv(path))


def unreadable_records(spark: SparkSession, path: str, schema: StructType, sep: str = ",",
                       quoted_newlines: bool = False) -> int:
    """How many records of a CSV hold a field that does not parse, or too many or too few fields."""
    wide = StructType([*schema.fields, StructField("_record", StringType())])
    frame = (spark.read.schema(wide).option("header", True).option("sep", sep).option("multiLine", quoted_newlines)
             .option("escape", '"').option("columnNameOfCorruptRecord", "_record").csv(path))
    # all fields are counted, so all are parsed
    return frame.agg(F.count("_record"), *[F.count(F.col(f"`{c}`")) for c in schema.names]).first()[0]


def read_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One JSON object per line; lists stay arrays."""
    return spark.read.schema(schema).json(path)


def read_table_columns(spark: SparkSession, path: str, columns: Sequence[str],
                       fmt: str = "parquet") -> DataFrame:
    """Some columns of a local copy of an external table."""
    return spark.read.format(fmt).load(path).select(*columns)


def write_csv(frame: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists") -> None:
    """CSV with a header, one file per task; array columns are not CSV, join them first."""
    (frame.write.mode(mode).option("header", True).option("sep", sep)
     .option("escape", '"').csv(path))


def _is_complete(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def build_once(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Read the extract at ``path``; build and write it first when it is not there.

    The commit marker decides, so what a lost job left half written is built anew.
    """
    if not _is_complete(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def column_info(frame: DataFrame) -> DataFrame:
    """One row per column: name, type, number of non-null values.  One pass."""
    counted = frame.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in frame.columns])
    types = [F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"),
                      F.col(f"`{c}`").alias("non_null")) for c, t in frame.dtypes]
    return counted.select(F.inline(F.array(*types)))


def preview(frame: DataFrame, n: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    """First rows; with an order they are the same rows on every run."""
    return (frame.orderBy(*order_by) if order_by else frame).limit(n)
