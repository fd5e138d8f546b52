"""Sorts, limits and top-k (SRT)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastegrid.operators import aggregate, encode, ranking
from tastegrid.plans.registry import registered
from tastegrid.plans.twin import over
from tastegrid.sources import domain


@registered("srt1_sorted_by_key", over("reviews", """
    SELECT item_id, count(*) AS "count" FROM reviews GROUP BY item_id ORDER BY item_id"""))
def sorted_by_key(spark, folder):
    return aggregate.count_per(domain.reviews(spark, folder), "item_id").orderBy("item_id")


@registered("srt2_top_users", over("interactions", """
    SELECT user_id, count(*) AS "count" FROM interactions GROUP BY user_id
    ORDER BY "count" DESC, user_id LIMIT 100"""))
def top_users(spark, folder):
    return ranking.top_n(aggregate.count_per(domain.interactions(spark, folder), "user_id"), "count", "user_id", 100)


@registered("srt3_bottom_tags", over("item_tags", """
    SELECT tag, count(*) AS "count" FROM item_tags GROUP BY tag ORDER BY "count", tag LIMIT 10"""))
def bottom_tags(spark, folder):
    from tastegrid.plans.joining import tags
    return ranking.top_n(aggregate.count_per(tags(spark, folder), "tag"), "count", "tag", 10, largest=False)


@registered("srt4_best_row", """
    SELECT l_suppkey, round(avg(l_discount), 9) AS mean_discount FROM lineitem GROUP BY l_suppkey
    ORDER BY mean_discount DESC, l_suppkey LIMIT 1""")
def best_row(spark, folder):
    means = (domain.table(spark, folder, "lineitem").groupBy("l_suppkey")
             .agg(F.round(F.avg("l_discount"), 9).alias("mean_discount")))
    return ranking.best_by(means, "mean_discount", "l_suppkey")


@registered("srt5_order_of_another_table", over("reviews catalog", """
    SELECT DISTINCT r.item_id, idx FROM reviews r JOIN (
        SELECT item_id, row_number() OVER (ORDER BY md5(item_id::VARCHAR), item_id) - 1 AS idx FROM catalog) m
    ON m.item_id = r.item_id WHERE is_recommended ORDER BY idx"""))
def order_of_another_table(spark, folder):
    index = encode.id_map(domain.catalog(spark, folder), "item_id").withColumnRenamed("raw_id", "item_id")
    liked = domain.reviews(spark, folder).where("is_recommended").select("item_id").distinct()
    return liked.join(index, "item_id").orderBy("idx")


@registered("srt6_top_items_per_user", over("interactions", """
    SELECT user_id, item_id, score, pos FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id)::INT AS pos FROM (
            SELECT user_id, item_id, sum(hours) AS score FROM interactions GROUP BY 1, 2))
    WHERE pos <= 5"""))
def top_items_per_user(spark, folder):
    scores = domain.interactions(spark, folder).groupBy("user_id", "item_id").agg(F.sum("hours").alias("score"))
    return ranking.top_k_per_group(scores, "user_id", [F.desc("score"), F.asc("item_id")], 5)
