"""The domain views, built on the given star-schema tables.

======================  ====================================================
``reviews``             one row per order line; the line is the review
``interactions``        reviews with the ordering customer as the user
``ratings``             one 1..5 rating per (user, item), the highest wins
``games``               parts as items, with facts drawn from their reviews
``metadata``            item, description, tag list (some lists are empty)
``extra_facts``         store URL and language list, drawn from documents
======================  ====================================================

Every view is lazy and reads only the columns its consumer asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid.functions import hashing, ratings as stars
from tastegrid.session import spread

# Cuts of the positive share that give a review label.
LABEL_CUTS = (
    (90, "Overwhelmingly Positive"),
    (80, "Very Positive"),
    (75, "Mostly Positive"),
    (70, "Positive"),
    (65, "Mixed"),
    (60, "Negative"),
    (50, "Mostly Negative"),
    (40, "Very Negative"),
    (0, "Overwhelmingly Negative"),
)
URL_START = "https://store.example.com/apps/app/"
URL_END = "/about/index.htm"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews without their user; item-side questions need no join."""
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return table(spark, folder, "lineitem").select(
        key.alias("review_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("item_id"),
        (F.col("l_returnflag") != "R").alias("is_recommended"),
        F.col("l_quantity").alias("hours"),
        F.col("l_linenumber").alias("helpful"),
        F.to_date("l_shipdate").alias("date"),
    )


def interactions(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews with ``user_id``."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"))
    return reviews(spark, folder).join(orders, "order_id", "inner")


def rated(frame: DataFrame, seed: int = 42) -> DataFrame:
    """Add a 1..5 ``rank`` drawn from the flag."""
    u = hashing.unit(hashing.draw(F.col("review_id"), seed))
    return frame.withColumn("rank", stars.stars_from_flag(F.col("is_recommended"), u))


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """user_id, item_id, rating: one row per pair, the highest rating wins.

    A review's stars are drawn before its user is joined, so its text key does not
    travel, and the tasks rise with the reviews.
    """
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"))
    drawn = rated(reviews(spark, folder)).select("order_id", "item_id", F.col("rank").cast("tinyint").alias("rank"))
    many = table(spark, folder, "lineitem").count()  # from the footers of the files
    rows = spread(drawn, many, "order_id").join(orders, "order_id").select("user_id", "item_id", "rank")
    return (spread(rows, many, "user_id", "item_id").groupBy("user_id", "item_id")
            .agg(F.max("rank").cast("double").alias("rating")))


def item_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Release date, positive share and review count of every reviewed item."""
    liked = F.col("is_recommended").cast("double")
    return reviews(spark, folder).groupBy("item_id").agg(
        F.min("date").alias("date_release"),
        F.round(F.avg(liked) * F.lit(100.0)).cast("int").alias("positive_ratio"),
        F.count(F.lit(1)).alias("user_reviews"))


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Items with the facts that need no review."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("title"),
        (F.col("p_type") != "PROMO").alias("win"),
        (F.col("p_size") % 3 == 0).alias("mac"),
        F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3").alias("linux"),
        (F.col("p_size") * F.lit(2.0)).alias("price_final"),
        F.col("p_retailprice").alias("price_original"),
        (F.col("p_type") == "LARGE").alias("handheld"),
    )


def _label(ratio: Column) -> Column:
    chain = None
    for cut, name in LABEL_CUTS:
        chain = F.when(ratio >= cut, name) if chain is None else chain.when(ratio >= cut, name)
    return chain


def games(spark: SparkSession, folder: str) -> DataFrame:
    """The catalogue with release date, positive share and review label."""
    full = catalog(spark, folder).join(item_facts(spark, folder), "item_id", "left")
    return full.withColumn("rating", _label(F.col("positive_ratio")))


def metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Items with a tag list: the words of their names."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.concat_ws(" ", "p_brand", "p_type").alias("description"),
        F.split("p_name", " ").alias("tags"))


def metadata_text(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the list as text, the way a CSV keeps it."""
    joined = F.array_join("tags", "', '")
    text = F.when(F.size("tags") == 0, "[]").otherwise(F.concat(F.lit("['"), joined, F.lit("']")))
    return metadata(spark, folder).select("item_id", "description", text.alias("tags"))


def extra_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Five columns of an outside table: URL, score, platform, tags, languages."""
    key = F.col("doc_id")
    url = F.concat(F.lit(URL_START), key.cast("string"), F.lit(URL_END))
    tongues = F.concat(F.lit("['"), F.col("lang"), F.lit("', 'sub "), F.col("source"), F.lit("']"))
    return table(spark, folder, "documents").select(
        url.alias("url"),
        (F.col("n_chars") % 100).cast("int").alias("metacritic"),
        F.lit("PC").alias("platform"),
        F.col("source").alias("tags"),
        tongues.alias("languages"))
