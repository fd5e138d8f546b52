"""Joins (JN) and set operations (SET)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastegrid.functions import text as tx
from tastegrid.operators import aggregate, encode, joins, sample
from tastegrid.plans.registry import registered
from tastegrid.plans.twin import over
from tastegrid.sources import domain


def languages(spark, folder):
    """(item_id, language) from the outside table: keys cut from URLs, NULLs dropped."""
    facts = (domain.extra_facts(spark, folder)
             .where("url IS NOT NULL AND tags IS NOT NULL AND languages IS NOT NULL")
             .select(tx.url_key(F.col("url")).try_cast("bigint").alias("item_id"), "languages"))
    return encode.labels_of(facts, "item_id", "languages", "language")


def tags(spark, folder):
    """(item_id, tag) from lists held as text, empty lists dropped."""
    kept = domain.metadata_text(spark, folder).where(F.length("tags") != 2)
    return encode.labels_of(kept, "item_id", "tags", "tag")


_FACTS = """SELECT CAST(substr(url, 36, length(url) - 51) AS BIGINT) AS item_id, languages
            FROM extra_facts WHERE url IS NOT NULL"""


def _facts(spark, folder):
    return (domain.extra_facts(spark, folder).where("url IS NOT NULL")
            .select(tx.url_key(F.col("url")).try_cast("bigint").alias("item_id"), "languages"))


@registered("jn1_left_joins", over("catalog metadata_text extra_facts", """
    SELECT c.item_id, c.title, f.languages, m.tags FROM catalog c
    LEFT JOIN facts f ON f.item_id = c.item_id LEFT JOIN metadata_text m ON m.item_id = c.item_id""",
    facts=_FACTS))
def left_joins(spark, folder):
    return joins.left_join(domain.catalog(spark, folder).select("item_id", "title"), _facts(spark, folder),
                           domain.metadata_text(spark, folder).select("item_id", "tags"), on="item_id")


@registered("jn2_left_join_reviews", over("catalog reviews", """
    SELECT c.item_id, c.price_final, r.hours, r.is_recommended
    FROM catalog c LEFT JOIN reviews r ON r.item_id = c.item_id"""))
def left_join_reviews(spark, folder):
    found = domain.reviews(spark, folder).select("item_id", "hours", "is_recommended")
    return joins.left_join_events(domain.catalog(spark, folder).select("item_id", "price_final"), found, "item_id")


@registered("jn3_three_way_inner_join", over("catalog item_tags item_languages", """
    SELECT c.item_id, c.price_final, t.tag, l.language FROM catalog c
    JOIN item_languages l ON l.item_id = c.item_id JOIN item_tags t ON t.item_id = c.item_id"""))
def three_way_inner_join(spark, folder):
    return joins.inner_join(domain.catalog(spark, folder).select("item_id", "price_final"),
                            languages(spark, folder), tags(spark, folder), on="item_id")


@registered("jn4_reviews_with_tags", over("reviews item_tags", """
    SELECT r.item_id, r.is_recommended, t.tag FROM reviews r JOIN item_tags t ON t.item_id = r.item_id"""))
def reviews_with_tags(spark, folder):
    return joins.inner_join(domain.reviews(spark, folder).select("item_id", "is_recommended"),
                            tags(spark, folder), on="item_id")


@registered("jn5_price_with_review_count", over("catalog reviews", """
    SELECT c.item_id, price_final, review_count FROM catalog c
    JOIN (SELECT item_id, count(*) AS review_count FROM reviews GROUP BY item_id) r ON r.item_id = c.item_id"""))
def price_with_review_count(spark, folder):
    return joins.with_group_size(domain.catalog(spark, folder).select("item_id", "price_final"),
                                 domain.reviews(spark, folder), "item_id", "review_count")


@registered("jn6_aligned_series", over("games reviews", """
    SELECT g.item_id, month(date_release)::INT AS month, review_count FROM games g
    JOIN (SELECT item_id, count(*) AS review_count FROM reviews GROUP BY item_id) r ON r.item_id = g.item_id
    WHERE date_release IS NOT NULL"""))
def aligned_series(spark, folder):
    month = (domain.item_facts(spark, folder).where("date_release IS NOT NULL")
             .select("item_id", F.month("date_release").alias("month")))
    known = joins.keep_matching(month, domain.catalog(spark, folder), "item_id")
    return joins.with_group_size(known, domain.reviews(spark, folder), "item_id", "review_count")


@registered("jn7_attach_encoded_columns", over("metadata", """
    SELECT item_id, coalesce(COLUMNS(* EXCLUDE item_id), 0)::INT FROM (SELECT item_id FROM metadata) LEFT JOIN (
        PIVOT (SELECT DISTINCT item_id, unnest(tags) AS tag FROM metadata) ON tag USING count(*) GROUP BY item_id)
    USING (item_id)"""))
def attach_encoded_columns(spark, folder):
    return encode.attach_labels(domain.metadata(spark, folder).select("item_id", "tags"), "tags")


@registered("jn8_semi_join", over("reviews item_languages", """
    SELECT item_id, hours FROM reviews WHERE item_id IN (SELECT item_id FROM item_languages)"""))
def semi_join(spark, folder):
    return joins.keep_matching(domain.reviews(spark, folder).select("item_id", "hours"),
                               languages(spark, folder), "item_id")


@registered("jn9_semi_join_most_active", over("interactions", """
    SELECT user_id, item_id FROM interactions WHERE user_id IN (
        SELECT user_id FROM interactions GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 300)"""))
def semi_join_most_active(spark, folder):
    found = domain.interactions(spark, folder).select("user_id", "item_id")
    return joins.keep_most_active(found, "user_id", 300)


@registered("jn10_anti_join_drawn_users", over("interactions", """
    SELECT DISTINCT user_id FROM interactions WHERE user_id NOT IN (
        SELECT user_id FROM (SELECT DISTINCT user_id FROM interactions)
        WHERE substr(md5('42:' || user_id), 1, 8) < '80000000')"""))
def anti_join_drawn_users(spark, folder):
    users = aggregate.distinct_values(domain.interactions(spark, folder), "user_id")
    drawn = sample.thin(users, F.col("user_id"), 0.5)
    return joins.drop_matching(users, drawn, "user_id")


@registered("jn11_anti_join_seen_items", over("interactions", """
    SELECT DISTINCT user_id, item_id FROM interactions i WHERE is_recommended AND NOT EXISTS (
        SELECT 1 FROM interactions s WHERE NOT s.is_recommended AND s.user_id = i.user_id
               AND s.item_id = i.item_id)"""))
def anti_join_seen_items(spark, folder):
    pairs = domain.interactions(spark, folder)
    candidates = pairs.where("is_recommended").select("user_id", "item_id").distinct()
    return joins.drop_matching(candidates, pairs.where("NOT is_recommended"), ["user_id", "item_id"])


@registered("set1_stacked_frames", over("interactions", """
    SELECT user_id, 'review' AS source FROM interactions
    UNION ALL SELECT user_id, 'event' AS source FROM events"""))
def stacked_frames(spark, folder):
    first = domain.interactions(spark, folder).select("user_id", F.lit("review").alias("source"))
    second = domain.table(spark, folder, "events").select(F.lit("event").alias("source"), "user_id")
    return first.unionByName(second)
