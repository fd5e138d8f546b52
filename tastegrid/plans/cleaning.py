"""Projections, filters and null handling (PRJ, FLT)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastegrid.functions import ratings as stars, text as tx
from tastegrid.operators import clean
from tastegrid.operators.aggregate import having_count
from tastegrid.plans.registry import registered
from tastegrid.plans.twin import LABEL_VALUES, over
from tastegrid.sources import domain


@registered("prj1_drop_columns", over("interactions", """
    SELECT user_id, item_id, is_recommended, hours FROM interactions"""))
def drop_columns(spark, folder):
    return clean.drop_columns(domain.interactions(spark, folder), "date", "helpful", "review_id", "order_id")


@registered("prj2_reorder_columns", over("rated", "SELECT user_id, item_id, rank FROM rated"))
def reorder_columns(spark, folder):
    return clean.reorder(domain.rated(domain.interactions(spark, folder)), "user_id", "item_id", "rank")


@registered("prj3_rename_columns", over("interactions", """
    SELECT user_id, item_id AS app_id, is_recommended::INT AS weight FROM interactions"""))
def rename_columns(spark, folder):
    kept = domain.interactions(spark, folder).select("user_id", "item_id", "is_recommended")
    named = clean.rename(kept, {"item_id": "app_id", "is_recommended": "weight"})
    return clean.recast(named, {"weight": "int"})


@registered("prj4_recast_columns", over("catalog extra_facts", """
    SELECT c.item_id::VARCHAR AS item_id, win::INT::DOUBLE AS win, mac::INT::DOUBLE AS mac, linux::INT AS linux,
           price_final::BIGINT AS price_final, TRY_CAST(split_part(title, ' ', 1) AS BIGINT) AS title_number
    FROM catalog c"""))
def recast_columns(spark, folder):
    head = F.split_part("title", F.lit(" "), F.lit(1)).alias("title_number")
    frame = domain.catalog(spark, folder).select("item_id", "win", "mac", "linux", "price_final", head)
    return clean.recast(frame, {"item_id": "string", "win": "double", "mac": "double", "linux": "int",
                                "price_final": "bigint", "title_number": "bigint"})


@registered("prj5_key_column", over("extra_facts", """
    SELECT CAST(substr(url, 36, length(url) - 51) AS BIGINT) AS item_id, languages
    FROM extra_facts WHERE url IS NOT NULL"""))
def key_column(spark, folder):
    frame = clean.drop_nulls(domain.extra_facts(spark, folder).select("url", "languages"), ["url"])
    return clean.keyed(frame, tx.url_key(F.col("url")).try_cast("bigint"), "item_id").drop("url")


@registered("prj6_shift_and_rescale", over("games", f"""
    SELECT item_id, round(price_final / 100 + 1e-6, 9) AS price_share, (score + 4) / 8.0::DOUBLE AS rating_share
    FROM games LEFT JOIN (VALUES {LABEL_VALUES}) t(label, score) ON lower(rating) = label"""))
def shift_and_rescale(spark, folder):
    frame = domain.games(spark, folder).select(
        "item_id", (F.col("price_final") / 100).alias("price_share"),
        stars.label_score(F.col("rating")).alias("rating_share"))
    shifted = clean.shift(clean.rescale(frame, "rating_share", 4.0, 8.0), ["price_share"])
    return shifted.withColumn("price_share", F.round("price_share", 9))


@registered("prj7_title_lookup", over("rated catalog", """
    SELECT r.item_id, title, count(*) AS ratings FROM rated r JOIN catalog c ON c.item_id = r.item_id
    GROUP BY ALL"""))
def title_lookup(spark, folder):
    titles = domain.catalog(spark, folder).select("item_id", "title")
    counted = (domain.interactions(spark, folder).groupBy("item_id")
               .agg(F.count(F.lit(1)).alias("ratings")))
    return counted.join(titles, "item_id").select("item_id", "title", "ratings")


@registered("flt1_positive_reviews", over("interactions", """
    SELECT user_id, item_id FROM interactions WHERE is_recommended"""))
def positive_reviews(spark, folder):
    return clean.keep_flagged(domain.interactions(spark, folder), "is_recommended").select("user_id", "item_id")


@registered("flt2_users_over_threshold", over("interactions", """
    SELECT user_id, count(*) AS "count" FROM interactions GROUP BY user_id HAVING count(*) > 45"""))
def users_over_threshold(spark, folder):
    return having_count(domain.interactions(spark, folder), "user_id", more_than=45)


@registered("flt3_drop_nulls", over("extra_facts", """
    SELECT url, tags, languages FROM extra_facts WHERE url IS NOT NULL AND tags IS NOT NULL"""))
def drop_nulls(spark, folder):
    return clean.drop_nulls(domain.extra_facts(spark, folder).select("url", "tags", "languages"), ["url", "tags"])


@registered("flt3_drop_nulls_anywhere", over("extra_facts", """
    SELECT * FROM extra_facts WHERE url IS NOT NULL AND metacritic IS NOT NULL AND platform IS NOT NULL
    AND tags IS NOT NULL AND languages IS NOT NULL"""))
def drop_nulls_anywhere(spark, folder):
    return clean.drop_nulls(domain.extra_facts(spark, folder))


@registered("flt4_drop_empty_lists", over("metadata", """
    SELECT item_id, array_to_string(tags, ',') AS tags FROM metadata WHERE len(tags) > 0"""))
def drop_empty_lists(spark, folder):
    kept = clean.drop_empty_lists(domain.metadata(spark, folder), "tags")
    return kept.select("item_id", F.array_join("tags", ",").alias("tags"))


@registered("flt4_drop_empty_text_lists", over("metadata_text", """
    SELECT item_id, tags FROM metadata_text WHERE length(tags) <> 2"""))
def drop_empty_text_lists(spark, folder):
    return clean.drop_empty_lists(domain.metadata_text(spark, folder), "tags").select("item_id", "tags")


_LABELLED = """SELECT d.doc_id, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic
               FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""


@registered("flt5_fill_nulls", _LABELLED)
def fill_nulls(spark, folder):
    docs = domain.table(spark, folder, "documents").select("doc_id")
    return clean.fill_nulls(docs.join(domain.table(spark, folder, "labels"), "doc_id", "left"), 0)


@registered("flt6_null_mask", over("extra_facts", """
    SELECT url, metacritic IS NOT NULL AS metacritic, platform IS NOT NULL AS platform, tags IS NOT NULL AS tags,
           languages IS NOT NULL AS languages
    FROM extra_facts WHERE url IS NOT NULL"""))
def null_mask(spark, folder):
    frame = domain.extra_facts(spark, folder).where("url IS NOT NULL")
    return clean.null_mask(frame, keep=["url"])


@registered("flt6_null_profile", over("extra_facts", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS nulls,
        round((count(*) FILTER ({c} IS NULL))::DOUBLE / count(*), 6) AS share FROM extra_facts"""
    for c in ("url", "metacritic", "platform", "tags", "languages"))))
def null_profile(spark, folder):
    profile = clean.null_profile(domain.extra_facts(spark, folder))
    return profile.withColumn("share", F.round("share", 6))
