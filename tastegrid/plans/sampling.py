"""Samples and splits (SMP)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastegrid.functions import hashing, ratings as stars
from tastegrid.operators import sample
from tastegrid.plans.aggregates import BAND_SQL, banded_users
from tastegrid.plans.registry import registered
from tastegrid.plans.twin import over, unit
from tastegrid.sources import domain

QUOTAS = {"1-5": 60, "6-10": 60, "11-15": 60, "15+": 20}
PANEL = 400
_QUOTA_CASE = "CASE band " + " ".join(f"WHEN '{b}' THEN {q}" for b, q in QUOTAS.items()) + " END"
RANKED_SQL = f"""
    SELECT *, {_QUOTA_CASE} AS quota, count(*) OVER (PARTITION BY band) AS size,
           row_number() OVER (PARTITION BY band ORDER BY md5('42:' || user_id), user_id) AS rn FROM banded"""
LIMITS_SQL = f"""
    SELECT band, least(size, quota) AS taken,
           least(size - least(size, quota), greatest({PANEL} - sum(least(size, quota)) OVER (), 0)
                 * (size - least(size, quota)) // greatest(sum(size - least(size, quota)) OVER (), 1)) AS extra
    FROM (SELECT DISTINCT band, size, quota FROM ranked)"""
PANEL_SQL = """SELECT user_id, r.band, CASE WHEN rn <= taken THEN 'quota' ELSE 'extra' END AS source
    FROM ranked r JOIN limits l ON l.band = r.band WHERE rn <= taken + extra"""


def panel(spark, folder):
    """The stratified user panel."""
    return sample.stratified_panel(banded_users(spark, folder), "band", "user_id", QUOTAS, PANEL)


@registered("smp1_half_of_the_rows", over("reviews", """
    SELECT item_id, hours FROM reviews WHERE substr(md5('42:' || review_id), 1, 8) < '80000000'"""))
def half_of_the_rows(spark, folder):
    return sample.thin(domain.reviews(spark, folder), F.col("review_id")).select("item_id", "hours")


@registered("smp2_quota_per_stratum", over("", """
    SELECT user_id, band, n_reviews FROM ranked WHERE rn <= quota""", banded=BAND_SQL, ranked=RANKED_SQL))
def quota_per_stratum(spark, folder):
    return sample.quota_sample(banded_users(spark, folder), "band", "user_id", QUOTAS)


@registered("smp3_proportional_fill", over("", f"SELECT user_id, band FROM ({PANEL_SQL}) WHERE source = 'extra'",
                                           banded=BAND_SQL, ranked=RANKED_SQL, limits=LIMITS_SQL))
def proportional_fill(spark, folder):
    return panel(spark, folder).where("source = 'extra'").select("user_id", "band")


@registered("smp4_random_users", over("interactions", """
    SELECT user_id FROM (SELECT DISTINCT user_id FROM interactions)
    ORDER BY md5('42:' || user_id), user_id LIMIT 3"""))
def random_users(spark, folder):
    return sample.random_keys(domain.interactions(spark, folder), "user_id", 3)


@registered("smp5_rating_from_flag", over("rated", """
    SELECT is_recommended, rank, count(*) AS n FROM rated GROUP BY ALL"""))
def rating_from_flag(spark, folder):
    return (domain.rated(domain.reviews(spark, folder)).groupBy("is_recommended", "rank")
            .agg(F.count(F.lit(1)).alias("n")))


_U = unit("md5('42:' || review_id)")


@registered("smp6_rating_uniform", over("reviews", f"""
    SELECT item_id, CASE WHEN is_recommended THEN 3 + floor({_U} * 3.0::DOUBLE)
                         ELSE 1 + floor({_U} * 2.0::DOUBLE) END::INT AS rank FROM reviews"""))
def rating_uniform(spark, folder):
    u = hashing.unit(hashing.draw(F.col("review_id")))
    return domain.reviews(spark, folder).select(
        "item_id", stars.stars_uniform(F.col("is_recommended"), u).alias("rank"))


def pair_hash(user: str = "user_id", item: str = "item_id", seed: int = 42) -> str:
    """SQL digest of a (user, item) pair."""
    return f"md5('{seed}:' || {user} || '|' || {item})"


@registered("smp7_ratings_split", over("ratings", f"""
    SELECT user_id, item_id, rating, substr({pair_hash()}, 1, 8) < '4ccccccc' AS is_test FROM ratings"""))
def ratings_split(spark, folder):
    return sample.with_split(domain.ratings(spark, folder), sample.key_of("user_id", "item_id"), 0.3)


@registered("smp8_interactions_split", over("interactions", f"""
    SELECT DISTINCT user_id, item_id, substr({pair_hash()}, 1, 8) < '33333333' AS is_test
    FROM interactions WHERE is_recommended"""))
def interactions_split(spark, folder):
    pairs = domain.interactions(spark, folder).where("is_recommended").select("user_id", "item_id").distinct()
    return sample.with_split(pairs, sample.key_of("user_id", "item_id"), 0.2)


@registered("smp9_feature_target_split", """
    SELECT doc_id, quality, substr(md5('42:' || doc_id), 1, 8) < '33333333' AS is_test FROM labels""")
def feature_target_split(spark, folder):
    labels = domain.table(spark, folder, "labels").select("doc_id", "quality")
    return sample.with_split(labels, sample.key_of("doc_id"), 0.2)


@registered("smp10_five_folds", over("ratings", f"""
    SELECT user_id, item_id, (CAST('0x' || substr({pair_hash()}, 1, 8) AS BIGINT) % 5)::INT AS fold FROM ratings"""))
def five_folds(spark, folder):
    folded = sample.with_fold(domain.ratings(spark, folder), sample.key_of("user_id", "item_id"), 5)
    return folded.select("user_id", "item_id", "fold")
