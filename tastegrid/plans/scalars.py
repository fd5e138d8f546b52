"""Scalar functions (SC) and the user-function surface (UD)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tastegrid.functions import hashing, ratings as stars, text as tx
from tastegrid.operators import clean, encode
from tastegrid.plans.registry import registered
from tastegrid.plans.twin import LABEL_VALUES, over
from tastegrid.sources import domain


@registered("sc1_url_slice", over("extra_facts", """
    SELECT url, substr(url, 36, greatest(length(url) - 51, 0)) AS item_id FROM extra_facts WHERE url IS NOT NULL"""))
def url_slice(spark, folder):
    facts = domain.extra_facts(spark, folder).where("url IS NOT NULL")
    return facts.select("url", tx.url_key(F.col("url")).alias("item_id"))


@registered("sc1_url_number", """
    SELECT page_id, CAST(nullif(regexp_extract(url, '/(\\d+)', 1), '') AS BIGINT) AS number FROM pages""")
def url_number(spark, folder):
    return domain.table(spark, folder, "pages").select("page_id", tx.url_number(F.col("url")).alias("number"))


@registered("sc2_strip_list", over("extra_facts", """
    SELECT url, regexp_replace(languages, '[ \\[\\]'']', '', 'g') AS languages FROM extra_facts"""))
def strip_list(spark, folder):
    return domain.extra_facts(spark, folder).select("url", tx.strip_list(F.col("languages")).alias("languages"))


@registered("sc3_split_list", over("extra_facts", """
    SELECT url, part[1] AS first, part[2] AS second, len(part)::INT AS n FROM (
        SELECT url, string_split(regexp_replace(languages, '[ \\[\\]'']', '', 'g'), ',') AS part
        FROM extra_facts WHERE languages IS NOT NULL)"""))
def split_list(spark, folder):
    parts = domain.extra_facts(spark, folder).where("languages IS NOT NULL").select(
        "url", tx.list_from_text(F.col("languages")).alias("part"))
    return parts.select("url", F.get("part", 0).alias("first"), F.get("part", 1).alias("second"),
                        F.size("part").alias("n"))


@registered("sc4_list_to_rows", over("metadata", """
    SELECT item_id, unnest(tags) AS tag FROM metadata"""))
def list_to_rows(spark, folder):
    return encode.list_to_rows(domain.metadata(spark, folder).select("item_id", "tags"), "tags", "tag")


@registered("sc4_list_to_rows_outer", over("metadata", """
    SELECT item_id, unnest(CASE WHEN len(tags) = 0 THEN [NULL] ELSE tags END) AS tag FROM metadata"""))
def list_to_rows_outer(spark, folder):
    return encode.list_to_rows(domain.metadata(spark, folder).select("item_id", "tags"), "tags", "tag", keep_empty=True)


@registered("sc5_text_length", "SELECT doc_id, length(text)::INT AS n FROM documents")
def text_length(spark, folder):
    return domain.table(spark, folder, "documents").select("doc_id", F.length("text").alias("n"))


@registered("sc6_text_to_date", """
    SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE)::VARCHAR AS day,
           TRY_CAST(o_orderpriority AS DATE)::VARCHAR AS not_a_day FROM orders""")
def text_to_date(spark, folder):
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    return domain.table(spark, folder, "orders").select(
        "o_orderkey", text.try_cast("date").cast("string").alias("day"),
        F.col("o_orderpriority").try_cast("date").cast("string").alias("not_a_day"))


@registered("sc7_year_and_month", """
    SELECT o_orderkey, year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month FROM orders""")
def year_and_month(spark, folder):
    return domain.table(spark, folder, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))


@registered("sc8_lower_text", over("catalog", """
    SELECT item_id, lower(title) AS title, lower(win::VARCHAR) AS win FROM catalog"""))
def lower_text(spark, folder):
    return domain.catalog(spark, folder).select(
        "item_id", tx.lower_text(F.col("title")).alias("title"), tx.lower_text(F.col("win")).alias("win"))


@registered("sc9_label_score", over("games", f"""
    SELECT item_id, rating, score::INT AS score FROM games
    LEFT JOIN (VALUES {LABEL_VALUES}) t(label, score) ON lower(rating) = label"""))
def label_score(spark, folder):
    return domain.games(spark, folder).select(
        "item_id", "rating", stars.label_score(F.col("rating")).alias("score"))


@registered("sc10_rounding", """
    SELECT l_orderkey, round(price, 1)::DOUBLE AS one, round(price, 0)::DOUBLE AS zero
    FROM (SELECT l_orderkey, l_extendedprice::DECIMAL(18, 2) AS price FROM lineitem)""")
def rounding(spark, folder):
    """Halves go away from zero on the decimal digits of the number."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return domain.table(spark, folder, "lineitem").select(
        "l_orderkey", F.round(price, 1).cast("double").alias("one"),
        F.round(price, 0).cast("double").alias("zero"))


@registered("ud1_function_per_row", over("rated", "SELECT user_id, item_id, rank FROM rated"))
def function_per_row(spark, folder):
    rows = domain.interactions(spark, folder)
    u = hashing.unit(hashing.draw(F.col("review_id")))
    return rows.select("user_id", "item_id", stars.stars_from_flag(F.col("is_recommended"), u).alias("rank"))


@registered("ud1_vectorised_user_code", """
    SELECT p_partkey, upper(substr(p_name, 1, 1)) || substr(p_name, 2) AS title FROM part""")
def vectorised_user_code(spark, folder):
    """User code that has no expression form goes through Arrow batches."""
    @F.pandas_udf("string")
    def capital(names: pd.Series) -> pd.Series:
        return names.str[:1].str.upper() + names.str[1:]
    return domain.table(spark, folder, "part").select("p_partkey", capital("p_name").alias("title"))


@registered("ud2_function_per_group", over("reviews", """
    SELECT item_id, min(date)::VARCHAR AS first, max(date)::VARCHAR AS last,
           date_diff('day', min(date), max(date))::INT AS days FROM reviews GROUP BY item_id"""))
def function_per_group(spark, folder):
    """A function of a group's reviews, as aggregates that combine before the shuffle."""
    first, last = F.min("date"), F.max("date")
    return domain.reviews(spark, folder).groupBy("item_id").agg(
        first.cast("string").alias("first"), last.cast("string").alias("last"),
        F.date_diff(last, first).alias("days"))


@registered("ud3_groups_collected", over("interactions", """
    SELECT user_id, n, mean_hours FROM (
        SELECT user_id, count(*) AS n, round(avg(hours), 6) AS mean_hours FROM interactions GROUP BY user_id)"""))
def groups_collected(spark, folder):
    """What a loop over groups gathers, in one distributed aggregation."""
    return domain.interactions(spark, folder).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("hours"), 6).alias("mean_hours"))
