"""Scans, sources and sinks (SRC)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastegrid.functions import hashing
from tastegrid.plans.registry import registered
from tastegrid.plans.twin import over
from tastegrid.session import scratch_path
from tastegrid.sources import domain, files

REVIEW_FILE = T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("review_id", T.StringType()),
    T.StructField("is_recommended", T.BooleanType()), T.StructField("hours", T.DoubleType()),
    T.StructField("date", T.DateType()),
])
REVIEW_COLUMNS = [f.name for f in REVIEW_FILE.fields]
METADATA_FILE = T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("description", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
])
_BY_ITEM = """SELECT item_id, count(*) AS reviews, sum(hours) AS hours,
                     sum(is_recommended::INT)::BIGINT AS liked, max(date)::VARCHAR AS last_date
              FROM reviews GROUP BY item_id"""


def _by_item(frame):
    return frame.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("reviews"), F.sum("hours").alias("hours"),
        F.sum(F.col("is_recommended").cast("bigint")).alias("liked"),
        F.max("date").cast("string").alias("last_date"))


@registered("src1_csv_scan", over("reviews", _BY_ITEM))
def csv_scan(spark, folder):
    path = scratch_path(spark, "reviews-csv")
    files.write_csv(domain.reviews(spark, folder).select(REVIEW_COLUMNS), path)
    return _by_item(files.read_csv(spark, path, REVIEW_FILE))


@registered("src2_csv_semicolon_scan", over("reviews", _BY_ITEM))
def csv_semicolon_scan(spark, folder):
    path = scratch_path(spark, "reviews-ssv")
    files.write_csv(domain.reviews(spark, folder).select(REVIEW_COLUMNS), path, sep=";")
    return _by_item(files.read_csv(spark, path, REVIEW_FILE, sep=";"))


@registered("src3_json_lines_scan", over("metadata", """
    SELECT item_id, description, array_to_string(tags, ',') AS tags, len(tags)::INT AS n_tags FROM metadata"""))
def json_lines_scan(spark, folder):
    path = scratch_path(spark, "metadata-json")
    domain.metadata(spark, folder).write.json(path)
    return files.read_json_lines(spark, path, METADATA_FILE).select(
        "item_id", "description", F.array_join("tags", ",").alias("tags"), F.size("tags").alias("n_tags"))


@registered("src4_table_columns", over("extra_facts", """
    SELECT url, metacritic, platform, tags, languages FROM extra_facts"""))
def table_columns(spark, folder):
    return domain.extra_facts(spark, folder).select("url", "metacritic", "platform", "tags", "languages")


@registered("src5_csv_sink", over("catalog", """
    SELECT item_id, title, win, price_final FROM catalog"""))
def csv_sink(spark, folder):
    schema = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("title", T.StringType()),
                           T.StructField("win", T.BooleanType()), T.StructField("price_final", T.DoubleType())])
    path = scratch_path(spark, "catalog-csv")
    files.write_csv(domain.catalog(spark, folder).select(schema.names), path)
    return files.read_csv(spark, path, schema)


@registered("src6_build_once_extract", over("reviews", f"""
    SELECT item_id, count(*) AS reviews FROM reviews
    WHERE substr(md5('42:' || review_id), 1, 8) < '80000000' GROUP BY item_id"""))
def build_once_extract(spark, folder):
    path = scratch_path(spark, "half")

    def half():
        kept = domain.reviews(spark, folder).select("item_id", "review_id")
        return kept.where(hashing.drawn_below(hashing.draw(F.col("review_id")), 0.5))
    files.build_once(spark, path, half)
    return (files.build_once(spark, path, half).groupBy("item_id")
            .agg(F.count(F.lit(1)).alias("reviews")))


@registered("src7_interaction_triples", over("interactions", """
    SELECT user_id::VARCHAR AS user_id, item_id::VARCHAR AS item_id, 1.0::DOUBLE AS weight
    FROM interactions WHERE is_recommended"""))
def interaction_triples(spark, folder):
    liked = domain.interactions(spark, folder).where("is_recommended")
    return liked.select(F.col("user_id").cast("string").alias("user_id"),
                        F.col("item_id").cast("string").alias("item_id"), F.lit(1.0).alias("weight"))


_INFO = {"item_id": "bigint", "title": "string", "win": "boolean", "mac": "boolean", "linux": "boolean",
         "price_final": "double", "price_original": "double", "handheld": "boolean", "date_release": "date",
         "positive_ratio": "int", "user_reviews": "bigint", "rating": "string"}


@registered("src8_column_info", over("games", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null FROM games" for c, t in _INFO.items())))
def column_info(spark, folder):
    return files.column_info(domain.games(spark, folder))


@registered("src8_preview", over("games", """
    SELECT item_id, title, price_final FROM games ORDER BY item_id LIMIT 5"""))
def preview(spark, folder):
    return files.preview(domain.catalog(spark, folder).select("item_id", "title", "price_final"), 5, ["item_id"])
