"""Composed questions (Q1-Q16); Q17 and Q18 sit with the recommenders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastegrid.functions import binning
from tastegrid.operators import aggregate, bins, joins, ranking, stored
from tastegrid.plans.aggregates import BAND_SQL
from tastegrid.plans.bins import PRICE_SQL, edges_twin, quantile_twin, width_twin
from tastegrid.plans.encoding import DATED, FEATURES_OVER, FEATURES_SQL, SCALED_SQL, item_features
from tastegrid.plans.joining import tags
from tastegrid.plans.registry import registered
from tastegrid.plans.sampling import LIMITS_SQL, PANEL_SQL, RANKED_SQL, panel
from tastegrid.plans.twin import over
from tastegrid.sources import domain

_PER_USER = "SELECT user_id, count(*) AS n FROM interactions GROUP BY user_id"
_PER_ITEM = "SELECT item_id, count(*) AS n FROM reviews GROUP BY item_id"
_ACTIVE = "SELECT user_id, count(*) AS n FROM interactions GROUP BY user_id HAVING count(*) > 40"


@registered("q1_users_by_review_decile", over("interactions", quantile_twin("counts"),
                                              counts=_PER_USER, edges=edges_twin("counts")))
def users_by_review_decile(spark, folder):
    counts = aggregate.count_per(domain.interactions(spark, folder), "user_id", name="n")
    return bins.quantile_histogram(counts, "n")


@registered("q2_items_by_review_decile", over("reviews", f"""
    SELECT *, round("count" * 100.0::DOUBLE / sum("count") OVER (), 1) AS percent FROM ({quantile_twin("counts")})""",
    counts=_PER_ITEM, edges=edges_twin("counts")))
def items_by_review_decile(spark, folder):
    counts = aggregate.count_per(domain.reviews(spark, folder), "item_id", name="n")
    return aggregate.share_of_total(bins.quantile_histogram(counts, "n"))


@registered("q3_active_users_by_decile", over("interactions", quantile_twin("counts"),
                                              counts=_ACTIVE, edges=edges_twin("counts")))
def active_users_by_decile(spark, folder):
    active = aggregate.having_count(domain.interactions(spark, folder), "user_id", more_than=40)
    return bins.quantile_histogram(active, "count")


@registered("q4_items_per_platform", over("catalog", """
    SELECT 'Windows' AS label, sum(win::INT)::BIGINT AS "count" FROM catalog
    UNION ALL SELECT 'macOS', sum(mac::INT)::BIGINT FROM catalog
    UNION ALL SELECT 'Linux', sum(linux::INT)::BIGINT FROM catalog"""))
def items_per_platform(spark, folder):
    return aggregate.flag_totals(domain.catalog(spark, folder),
                                 {"Windows": "win", "macOS": "mac", "Linux": "linux"})


@registered("q5_items_per_price_band", over("catalog", PRICE_SQL))
def items_per_price_band(spark, folder):
    return bins.cut_histogram(domain.catalog(spark, folder), "price_final", binning.PRICE_EDGES,
                              binning.PRICE_LABELS, right=False)


@registered("q6_positive_ratio_histogram", over("games", width_twin("games", "positive_ratio")))
def positive_ratio_histogram(spark, folder):
    facts = joins.keep_matching(domain.item_facts(spark, folder), domain.catalog(spark, folder), "item_id")
    table = bins.width_histogram(facts, "positive_ratio", bins=50)
    return table.withColumns({c: F.round(c, 6) for c in ("lo", "hi")})


@registered("q7_releases_per_month", over("games", """
    SELECT month(date_release)::INT AS month, count(*) AS "count" FROM games
    WHERE date_release IS NOT NULL GROUP BY 1"""))
def releases_per_month(spark, folder):
    facts = joins.keep_matching(domain.item_facts(spark, folder), domain.catalog(spark, folder), "item_id")
    return bins.month_histogram(facts, "date_release")


@registered("q8_price_and_positive_ratio", over("games", """
    SELECT round(corr(price_final, positive_ratio), 6) AS correlation FROM games"""))
def price_and_positive_ratio(spark, folder):
    found = aggregate.correlation(domain.games(spark, folder), "price_final", "positive_ratio")
    return found.select(F.round("correlation", 6).alias("correlation"))


@registered("q9_price_and_review_count", over("catalog reviews", """
    SELECT count(*) AS items, round(corr(price_final, n), 6) AS correlation
    FROM catalog c JOIN counts k ON k.item_id = c.item_id WHERE n < 35""", counts=_PER_ITEM))
def price_and_review_count(spark, folder):
    counted = joins.with_group_size(domain.catalog(spark, folder).select("item_id", "price_final"),
                                    domain.reviews(spark, folder), "item_id", "review_count")
    kept = counted.where(F.col("review_count") < 35)
    return kept.agg(F.count(F.lit(1)).alias("items"),
                    F.round(aggregate.safe_corr("price_final", "review_count"), 6).alias("correlation"))


@registered("q10_mean_reviews_by_release_month", over("games reviews", """
    SELECT month(date_release)::INT AS month, round(avg(n), 1) AS mean_reviews,
           round((SELECT avg(n) FROM counts), 1) AS overall_mean
    FROM games g JOIN counts k ON k.item_id = g.item_id WHERE date_release IS NOT NULL GROUP BY 1""",
    counts=_PER_ITEM))
def mean_reviews_by_release_month(spark, folder):
    """Release month and review count come from one aggregation of the reviews."""
    facts = domain.item_facts(spark, folder).select(
        "item_id", F.month("date_release").alias("month"), F.col("user_reviews").alias("n"))
    known = joins.keep_matching(facts.where("month IS NOT NULL"), domain.catalog(spark, folder), "item_id")
    table = aggregate.with_overall_mean(
        aggregate.group_mean(known, "month", "n", 1, "mean_reviews"), facts, "n")
    return table.withColumn("overall_mean", F.round("overall_mean", 1))


@registered("q11_top_tags_by_reviews", over("reviews item_tags", """
    SELECT tag, count(*) AS "count" FROM reviews r JOIN item_tags t ON t.item_id = r.item_id
    GROUP BY tag ORDER BY "count" DESC, tag LIMIT 10"""))
def top_tags_by_reviews(spark, folder):
    """Reviews are counted per item first: the join then sees items, never review rows."""
    counts = aggregate.count_per(domain.reviews(spark, folder), "item_id", name="n")
    per_tag = (counts.join(tags(spark, folder), "item_id").groupBy("tag").agg(F.sum("n").alias("count")))
    return ranking.top_n(per_tag, "count", "tag", 10)


@registered("q12_top_tags_by_items", over("item_tags", """
    SELECT tag, count(*) AS "count" FROM item_tags GROUP BY tag ORDER BY "count" DESC, tag LIMIT 10"""))
def top_tags_by_items(spark, folder):
    return ranking.top_n(aggregate.count_per(tags(spark, folder), "tag"), "count", "tag", 10)


def _density_sql(stage: str, source: str) -> str:
    return f"""SELECT '{stage}' AS stage, count(*) AS "rows", count(DISTINCT user_id) AS users,
               count(DISTINCT item_id) AS items,
               round(count(*)::DOUBLE / (count(DISTINCT user_id)::DOUBLE * count(DISTINCT item_id)), 9) AS density
               FROM {source}"""


_FEATURED = """SELECT user_id, item_id FROM interactions WHERE is_recommended
               AND item_id IN (SELECT item_id FROM item_languages)"""


@registered("q13_density_by_stage", over("interactions item_languages", " UNION ALL ".join([
    _density_sql("all", "interactions"), _density_sql("featured", "featured"), _density_sql("active", "active")]),
    featured=_FEATURED, active="""SELECT * FROM featured WHERE user_id IN (
        SELECT user_id FROM featured GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 500)"""))
def density_by_stage(spark, folder):
    """Rows are combined per pair once; every stage is a part of that table."""
    from tastegrid.plans.joining import languages
    spoken = languages(spark, folder).select("item_id").distinct().withColumn("_known", F.lit(1))
    pairs = stored.written(
        domain.interactions(spark, folder).groupBy("user_id", "item_id")
        .agg(F.count(F.lit(1)).alias("all"), F.count_if("is_recommended").alias("liked"))
        .join(spoken, "item_id", "left")
        .select("user_id", "item_id", "all", (F.col("liked") * F.coalesce("_known", F.lit(0))).alias("featured")), "pairs")
    busiest = (pairs.where("featured > 0").groupBy("user_id").agg(F.sum("featured").alias("n"))
               .orderBy(F.desc("n"), F.asc("user_id")).limit(500).select("user_id", F.lit(1).alias("_busy")))
    staged = pairs.join(busiest, "user_id", "left").select("user_id", "item_id", F.inline(F.array(
        F.struct(F.lit("all").alias("stage"), F.col("all").alias("n")),
        F.struct(F.lit("featured").alias("stage"), F.col("featured").alias("n")),
        F.struct(F.lit("active").alias("stage"), (F.col("featured") * F.coalesce("_busy", F.lit(0))).alias("n"))))).where("n > 0")
    sides = staged.select("stage", "n", F.inline(F.array(
        F.struct(F.lit(True).alias("is_user"), F.col("user_id").alias("id")),
        F.struct(F.lit(False).alias("is_user"), F.col("item_id").alias("id")))))
    values = sides.groupBy("stage", "is_user", "id").agg(F.sum("n").alias("n"))
    found = values.groupBy("stage").agg(F.sum(F.when(F.col("is_user"), F.col("n"))).alias("rows"),
                                        F.count_if("is_user").alias("users"), F.count_if(~F.col("is_user")).alias("items"))
    filled = F.try_divide(F.col("rows").cast("double"), F.col("users").cast("double") * F.col("items"))
    return found.withColumn("density", F.round(filled, 9))



@registered("q14_share_of_negative_ratings", over("rated", """
    SELECT round(avg((rank IN (1, 2))::INT::DOUBLE), 9) AS share FROM rated"""))
def share_of_negative_ratings(spark, folder):
    shares = aggregate.share_of_values(domain.rated(domain.reviews(spark, folder)), "rank", [1, 2])
    return shares.select(F.round("share", 9).alias("share"))


@registered("q15_panel_interactions", over("interactions", f"""
    SELECT p.band, p.source, count(DISTINCT i.user_id) AS users, count(*) AS reviews
    FROM interactions i JOIN ({PANEL_SQL}) p ON p.user_id = i.user_id GROUP BY 1, 2""",
    banded=BAND_SQL, ranked=RANKED_SQL, limits=LIMITS_SQL))
def panel_interactions(spark, folder):
    chosen = panel(spark, folder).select("user_id", "band", "source")
    per_user = aggregate.count_per(domain.interactions(spark, folder), "user_id", name="n")
    return (per_user.join(chosen, "user_id").groupBy("band", "source")
            .agg(F.count(F.lit(1)).alias("users"), F.sum("n").alias("reviews")))


@registered("q16_item_feature_matrix", over(FEATURES_OVER, """
    SELECT item_id, feature, round(value, 9) AS value FROM features""",
    dated=DATED, scaled=SCALED_SQL, features=FEATURES_SQL))
def item_feature_matrix(spark, folder):
    return item_features(spark, folder).withColumn("value", F.round("value", 9))
