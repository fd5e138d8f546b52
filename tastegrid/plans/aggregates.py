"""Aggregations (AG)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastegrid.functions import binning, text as tx
from tastegrid.operators import aggregate, encode, sample
from tastegrid.plans.registry import registered
from tastegrid.plans.twin import over
from tastegrid.sources import domain


@registered("ag1_count_per_user", over("interactions", """
    SELECT user_id, count(*) AS n_reviews FROM interactions GROUP BY user_id"""))
def count_per_user(spark, folder):
    return aggregate.count_per(domain.interactions(spark, folder), "user_id", name="n_reviews")


@registered("ag2_frequency_table", over("reviews", """
    SELECT item_id, count(*) AS "count" FROM reviews GROUP BY item_id"""))
def frequency_table(spark, folder):
    return aggregate.frequency(domain.reviews(spark, folder), "item_id")


@registered("ag3_distinct_counts", over("interactions", """
    SELECT count(DISTINCT user_id) AS user_id, count(DISTINCT item_id) AS item_id FROM interactions"""))
def distinct_counts(spark, folder):
    return aggregate.distinct_count(domain.interactions(spark, folder), "user_id", "item_id")


@registered("ag4_distinct_values", over("interactions", """
    SELECT DISTINCT item_id FROM interactions WHERE is_recommended"""))
def distinct_values(spark, folder):
    return aggregate.distinct_values(domain.reviews(spark, folder).where("is_recommended"), "item_id")


_URLS = """SELECT page_id, url, CAST(nullif(regexp_extract(url, '/(\\d+)', 1), '') AS BIGINT) AS number FROM pages"""


@registered("ag5_first_row_per_key", over("", """
    SELECT number, page_id, url FROM (
        SELECT *, row_number() OVER (PARTITION BY number ORDER BY page_id) AS rn FROM urls)
    WHERE rn = 1 AND number IS NOT NULL""", urls=_URLS))
def first_row_per_key(spark, folder):
    pages = domain.table(spark, folder, "pages").select(
        tx.url_number(F.col("url")).alias("number"), "page_id", "url")
    return aggregate.first_per_key(pages.where("number IS NOT NULL"), "number", ["page_id"])


@registered("ag6_items_per_platform", over("catalog", """
    SELECT 'Windows' AS label, sum(win::INT)::BIGINT AS "count" FROM catalog
    UNION ALL SELECT 'macOS', sum(mac::INT)::BIGINT FROM catalog
    UNION ALL SELECT 'Linux', sum(linux::INT)::BIGINT FROM catalog"""))
def items_per_platform(spark, folder):
    return aggregate.flag_totals(domain.catalog(spark, folder),
                                 {"Windows": "win", "macOS": "mac", "Linux": "linux"})


@registered("ag7_group_mean", over("reviews", """
    SELECT month(date)::INT AS month, round(avg(hours), 1) AS mean_hours FROM reviews GROUP BY 1"""))
def group_mean(spark, folder):
    frame = domain.reviews(spark, folder).select(F.month("date").alias("month"), "hours")
    return aggregate.group_mean(frame, "month", "hours", 1, "mean_hours")


@registered("ag8_overall_mean_beside_groups", over("reviews", """
    SELECT item_id, round(avg(hours), 6) AS mean, round((SELECT avg(hours) FROM reviews), 6) AS overall_mean
    FROM reviews GROUP BY item_id"""))
def overall_mean_beside_groups(spark, folder):
    found = domain.reviews(spark, folder)
    grouped = aggregate.with_overall_mean(aggregate.group_mean(found, "item_id", "hours"), found, "hours")
    return grouped.withColumns({c: F.round(c, 6) for c in ("mean", "overall_mean")})


@registered("ag9_groups_over_threshold", over("interactions", """
    SELECT count(*) AS groups FROM (
        SELECT user_id FROM interactions GROUP BY user_id HAVING count(*) > 40)"""))
def groups_over_threshold(spark, folder):
    return aggregate.groups_over(domain.interactions(spark, folder), "user_id", 40)


@registered("ag10_share_of_values", over("rated", """
    SELECT round(avg((rank IN (1, 2))::INT::DOUBLE), 9) AS share FROM rated"""))
def share_of_values(spark, folder):
    shares = aggregate.share_of_values(domain.rated(domain.interactions(spark, folder)), "rank", [1, 2])
    return shares.select(F.round("share", 9).alias("share"))


@registered("ag11_matrix_density", over("interactions", """
    SELECT "rows", users, items, round("rows"::DOUBLE / (users::DOUBLE * items), 9) AS density,
           round(1 - "rows"::DOUBLE / (users::DOUBLE * items), 9) AS sparsity
    FROM (SELECT count(*) AS "rows", count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items
          FROM interactions)"""))
def matrix_density(spark, folder):
    frame = aggregate.density(domain.interactions(spark, folder).select("user_id", "item_id"), "user_id", "item_id")
    return frame.withColumns({c: F.round(c, 9) for c in ("density", "sparsity")})


@registered("ag12_correlation", """
    SELECT round(corr(l_quantity, l_extendedprice), 6) AS correlation FROM lineitem""")
def correlation(spark, folder):
    found = aggregate.correlation(domain.table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice")
    return found.select(F.round("correlation", 6).alias("correlation"))


@registered("ag12_correlation_constant", """
    SELECT NULL::DOUBLE AS correlation""")
def correlation_constant(spark, folder):
    lines = domain.table(spark, folder, "lineitem").select("l_quantity", F.lit(1.0).alias("same"))
    return aggregate.correlation(lines, "l_quantity", "same")


_DESCRIBED = ("hours", "helpful")


@registered("ag13_column_summary", over("reviews", " UNION ALL ".join(f"""
    SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 6) AS mean,
           round(stddev_samp({c}), 6) AS std, min({c})::DOUBLE AS min,
           round(quantile_cont({c}, 0.25), 6)::DOUBLE AS q25, round(quantile_cont({c}, 0.5), 6)::DOUBLE AS q50,
           round(quantile_cont({c}, 0.75), 6)::DOUBLE AS q75, max({c})::DOUBLE AS max FROM reviews"""
    for c in _DESCRIBED)))
def column_summary(spark, folder):
    table = aggregate.describe(domain.reviews(spark, folder), *_DESCRIBED)
    return table.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q25", "q50", "q75")})


@registered("ag14_column_range", over("games", """
    SELECT min(price_final) AS price_final_min, max(price_final) AS price_final_max,
           min(positive_ratio) AS positive_ratio_min, max(positive_ratio) AS positive_ratio_max FROM games"""))
def column_range(spark, folder):
    return aggregate.column_range(domain.games(spark, folder), "price_final", "positive_ratio")


@registered("ag15_row_count", over("interactions", "SELECT count(*) AS \"rows\" FROM interactions"))
def row_count(spark, folder):
    return aggregate.row_count(domain.interactions(spark, folder))


@registered("ag16_share_of_total", """
    SELECT o_orderpriority, count(*) AS "count",
           round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM orders), 1) AS percent
    FROM orders GROUP BY 1""")
def share_of_total(spark, folder):
    return aggregate.share_of_total(
        aggregate.count_per(domain.table(spark, folder, "orders"), "o_orderpriority"))


@registered("ag17_small_mean_vectors", """
    SELECT count(*) FILTER (list_sum(list_transform(embedding, lambda x: x::DOUBLE)) / len(embedding) < 1e-3)
           AS small, count(*) AS vectors FROM embeddings""")
def small_mean_vectors(spark, folder):
    return aggregate.small_mean_vectors(domain.table(spark, folder, "embeddings"), "embedding")


BANDS = (0.0, 5.0, 10.0, 15.0, float("inf"))
BAND_LABELS = ("1-5", "6-10", "11-15", "15+")
BAND_SQL = """SELECT o_custkey AS user_id, count(*) AS n_reviews,
                     CASE WHEN count(*) <= 5 THEN '1-5' WHEN count(*) <= 10 THEN '6-10'
                          WHEN count(*) <= 15 THEN '11-15' ELSE '15+' END AS band
              FROM orders GROUP BY o_custkey"""


def banded_users(spark, folder):
    """Users with their activity band, by number of orders."""
    counts = (domain.table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("user_id"))
              .agg(F.count(F.lit(1)).alias("n_reviews")))
    band = binning.bin_label(binning.cut(F.col("n_reviews"), BANDS), BAND_LABELS)
    return counts.withColumn("band", band)


@registered("ag18_draw_inside_groups", over("", """
    SELECT user_id, band FROM (
        SELECT *, row_number() OVER (PARTITION BY band ORDER BY md5('42:' || user_id), user_id) AS rn FROM banded)
    WHERE rn <= 40""", banded=BAND_SQL))
def draw_inside_groups(spark, folder):
    drawn = sample.quota_sample(banded_users(spark, folder), "band", "user_id", {b: 40 for b in BAND_LABELS})
    return drawn.select("user_id", "band")


@registered("fe2_vocabulary_size", over("item_tags", "SELECT count(DISTINCT tag) AS labels FROM item_tags"))
def vocabulary_size(spark, folder):
    from tastegrid.plans.joining import tags
    return encode.vocabulary(tags(spark, folder), "tag")
