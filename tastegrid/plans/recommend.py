"""Rating models and recommendations (RC)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastegrid.functions.ratings import clip_rating
from tastegrid.operators import factors, implicit_factors, metrics, neighbours, recommend, sample, stored
from tastegrid.plans.registry import registered
from tastegrid.plans.sampling import pair_hash
from tastegrid.plans.twin import over, unit
from tastegrid.sources import domain

K = 40
SPLIT_SQL = f"SELECT *, substr({pair_hash()}, 1, 8) < '4ccccccc' AS is_test FROM ratings"
TRAIN_SQL = "SELECT user_id, item_id, rating FROM split WHERE NOT is_test"
TEST_SQL = "SELECT user_id, item_id, rating FROM split WHERE is_test"
SIDES = {"split": SPLIT_SQL, "train": TRAIN_SQL, "test": TEST_SQL}
CLIPPED = "greatest(1.0::DOUBLE, least(5.0::DOUBLE, {}))"


def sides(spark, folder):
    """(train, test) of the 70/30 split of the ratings, which are made once."""
    marked = sample.with_split(domain.ratings(spark, folder), sample.key_of("user_id", "item_id"), 0.3)
    rows = stored.written(marked, "ratings")
    return rows.where("not is_test").drop("is_test"), rows.where("is_test").drop("is_test")


def rounded(frame):
    """Predictions to six digits, so that the order of a sum does not show."""
    return frame.withColumn("prediction", F.round("prediction", 6))


@registered("rc1_clip_rating", over("interactions", f"""
    SELECT review_id, {CLIPPED.format("hours - 20")} AS prediction FROM interactions"""))
def clipped(spark, folder):
    return domain.interactions(spark, folder).select(
        "review_id", clip_rating(F.col("hours") - 20).alias("prediction"))


_U, _V = unit(pair_hash()), unit(pair_hash(seed=43))
NORMAL_SQL = f"""
    SELECT user_id, item_id, rating, {CLIPPED.format(f'''
           m + s * (sqrt(-2.0::DOUBLE * ln(1.0::DOUBLE - {_U})) * cos({_V} * 6.283185307179586::DOUBLE))''')} AS prediction
    FROM test, (SELECT avg(rating) AS m, sqrt(sum(rating * rating) / count(*) - avg(rating) * avg(rating)) AS s FROM train)"""


def normal_rows(spark, folder):
    train, test = sides(spark, folder)
    return neighbours.normal_predictions(train, test, sample.key_of("user_id", "item_id"))


@registered("rc2_normal_baseline", over("ratings", f"SELECT user_id, item_id, rating, round(prediction, 6) AS prediction FROM ({NORMAL_SQL})", **SIDES))
def normal_baseline(spark, folder):
    return rounded(normal_rows(spark, folder))


# Sums over common keys, whole numbers all of them.
FORMS = {
    "msd": "1.0::DOUBLE / (sum((a.rating - b.rating) * (a.rating - b.rating)) / count(*) + 1.0::DOUBLE)",
    "cosine": "sum(a.rating * b.rating) / (sqrt(sum(a.rating * a.rating)) * sqrt(sum(b.rating * b.rating)))",
    "pearson": """CASE WHEN count(*) >= 2 THEN (count(*) * sum(a.rating * b.rating) - sum(a.rating) * sum(b.rating))
        / nullif(sqrt((count(*) * sum(a.rating * a.rating) - sum(a.rating) * sum(a.rating))
                 * (count(*) * sum(b.rating * b.rating) - sum(b.rating) * sum(b.rating))), 0) END""",
}


def sims_sql(kind: str, of: str, other: str) -> str:
    return f"""SELECT a.{of} AS a, b.{of} AS b, {FORMS[kind]} AS sim, count(*) AS n
        FROM train a JOIN train b ON a.{other} = b.{other} AND a.{of} <> b.{of} GROUP BY ALL"""


def knn_sql(kind: str, user_based: bool, centred: bool) -> dict[str, str]:
    """Common tables sims, means, near, drawn, predicted."""
    of, other = ("user_id", "item_id") if user_based else ("item_id", "user_id")
    rating = "r.rating - m.own_mean" if centred else "r.rating"
    base = "coalesce(m.own_mean, (SELECT avg(rating) FROM train))"
    value = (f"{base} + coalesce(p, 0.0::DOUBLE)" if centred else "coalesce(p, (SELECT avg(rating) FROM train))")
    return {
        "sims": sims_sql(kind, of, other),
        "means": f"SELECT {of}, avg(rating) AS own_mean FROM train GROUP BY ALL",
        "near": f"""SELECT t.user_id, t.item_id, s.sim, {rating} AS rating,
                       row_number() OVER (PARTITION BY t.user_id, t.item_id ORDER BY s.sim DESC, s.b) AS rn
                    FROM test t JOIN train r ON r.{other} = t.{other}
                    JOIN sims s ON s.a = t.{of} AND s.b = r.{of} JOIN means m ON m.{of} = r.{of} WHERE s.sim > 0""",
        "drawn": f"SELECT user_id, item_id, sum(sim * rating) / sum(sim) AS p FROM near WHERE rn <= {K} GROUP BY ALL",
        "predicted": f"""SELECT t.user_id, t.item_id, t.rating, round({CLIPPED.format(value)}, 6) AS prediction
                         FROM test t LEFT JOIN drawn USING (user_id, item_id) LEFT JOIN means m ON m.{of} = t.{of}""",
    }


def _similarity(kind: str, user_based: bool) -> None:
    of, other = ("user_id", "item_id") if user_based else ("item_id", "user_id")
    side = "users" if user_based else "items"

    # likeness to the others of all users (items) that the test set asks about, the 10 nearest of each
    sql = over("ratings", f"""
        SELECT a, pos, b, sim FROM (
            SELECT a, b, sim, (row_number() OVER (PARTITION BY a ORDER BY sim DESC, b))::INT AS pos FROM sims
            WHERE sim IS NOT NULL AND a IN (SELECT {of} FROM test)) WHERE pos <= 10""",
               **SIDES, sims=sims_sql(kind, of, other))

    @registered(f"rc3_{kind}_{side}", sql)
    def similar(spark, folder):
        train, test = sides(spark, folder)
        sims = neighbours.similarities(train, test, of, other, kind, k=10)
        near = neighbours.top_k_per_group(sims, "a", [F.desc("sim"), F.asc("b")], 10)
        return near.select("a", "pos", "b", "sim")


def _neighbourhood(name: str, kind: str, user_based: bool, centred: bool) -> None:
    @registered(name, over("ratings", "SELECT * FROM predicted", **SIDES, **knn_sql(kind, user_based, centred)))
    def predicted(spark, folder):
        train, test = sides(spark, folder)
        return rounded(neighbours.knn_predictions(train, test, K, kind, user_based, centred))


for _kind in FORMS:
    for _user_based in (True, False):
        _similarity(_kind, _user_based)
_neighbourhood("rc4_knn_msd_users", "msd", True, False)
_neighbourhood("rc4_knn_cosine_items", "cosine", False, False)
_neighbourhood("rc5_knn_with_means", "msd", True, True)

# Likes split 80/20; a user shares the ranking of the user's nation.
LIKES = {
    "likes": f"""SELECT DISTINCT user_id, c_nationkey AS nation, item_id, substr({pair_hash()}, 1, 8) < '33333333' AS is_test
        FROM interactions JOIN customer ON c_custkey = user_id WHERE is_recommended""",
    "scores": "SELECT nation, item_id, count(*) AS score FROM likes WHERE NOT is_test GROUP BY ALL",
    "ranked": """SELECT nation, item_id, row_number() OVER (PARTITION BY nation ORDER BY score DESC, item_id) AS rank,
        count(*) OVER (PARTITION BY nation) AS n FROM scores""",
}


def nation_likes(spark, folder):
    """(train, test) pairs of liked items, with the user's nation."""
    nations = domain.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("nation"))
    pairs = (domain.interactions(spark, folder).where("is_recommended").select("user_id", "item_id").distinct()
             .join(nations, "user_id"))
    return sample.split(pairs, sample.key_of("user_id", "item_id"), 0.2)


def nation_ranking(train):
    """Items of every nation by number of likes there."""
    scores = train.groupBy("nation", "item_id").agg(F.count(F.lit(1)).alias("score"))
    return metrics.ranking(scores, "nation", "item_id", "score")


TOP_SQL = """
    SELECT user_id, pos::INT AS pos, item_id FROM (
        SELECT u.user_id, r.item_id, row_number() OVER (PARTITION BY u.user_id ORDER BY r.rank) AS pos
        FROM asked u JOIN ranked r USING (nation)
        WHERE NOT EXISTS (SELECT 1 FROM likes l WHERE NOT l.is_test AND l.user_id = u.user_id AND l.item_id = r.item_id))
    WHERE pos <= 5"""
ALL_USERS = "SELECT DISTINCT user_id, nation FROM likes WHERE NOT is_test"


@registered("rc10_scores_of_users", over("interactions", """
    SELECT nation, item_id, rank, n FROM ranked""", **LIKES))
def scores_of_users(spark, folder):
    return nation_ranking(nation_likes(spark, folder)[0])


@registered("rc11_top_unseen", over("interactions", TOP_SQL, **LIKES, asked=f"""
    SELECT * FROM ({ALL_USERS}) ORDER BY md5('42:' || user_id), user_id LIMIT 3"""))
def top_unseen(spark, folder):
    train, _ = nation_likes(spark, folder)
    asked = train.select("user_id", "nation").distinct().join(sample.random_keys(train, "user_id", 3), "user_id")
    return recommend.top_unseen(nation_ranking(train), asked, train, "nation", "user_id", "item_id")


@registered("rc12_batch_recommend", over("interactions", TOP_SQL, **LIKES, asked=ALL_USERS))
def batch_recommend(spark, folder):
    train, _ = nation_likes(spark, folder)
    return recommend.top_unseen(nation_ranking(train), train, train, "nation", "user_id", "item_id")


BIAS_SQL = f"""SELECT item_id, sum(rating - (SELECT avg(rating) FROM train)) / (count(*) + {factors.ITEM_DAMP}::DOUBLE) AS b_i
    FROM train GROUP BY ALL"""


@registered("rc6_biases", over("ratings", f"""
    SELECT user_id, round(sum(rating - (SELECT avg(rating) FROM train) - b_i) / (count(*) + {factors.USER_DAMP}::DOUBLE), 9) AS b_u
    FROM train JOIN item_bias USING (item_id) GROUP BY user_id""", **SIDES, item_bias=BIAS_SQL))
def user_biases(spark, folder):
    _, _, users = factors.biases(sides(spark, folder)[0])
    return users.select("user_id", F.round("b_u", 9).alias("b_u"))


# factors start from random numbers, so the two predictions have no SQL twin
@registered("rc6_biased_factors", None)
def biased_factors(spark, folder):
    return rounded(factors.biased_predictions(*sides(spark, folder)))


@registered("rc8_nonnegative_factors", None)
def nonnegative_factors(spark, folder):
    return rounded(factors.nonnegative_predictions(*sides(spark, folder)))


IMPLICIT = implicit_factors.Settings(no_components=8, epochs=8, learning_rate=0.05)


@registered("rc7_implicit_factors", None)
def implicit_predictions(spark, folder):
    return rounded(implicit_factors.implicit_predictions(*sides(spark, folder), IMPLICIT))


@registered("rc6_baseline_predictions", over("ratings", f"""
    SELECT t.user_id, t.item_id, t.rating, round({CLIPPED.format("""(SELECT avg(rating) FROM train)
        + coalesce(b_u, 0.0::DOUBLE) + coalesce(b_i, 0.0::DOUBLE)""")}, 6) AS prediction
    FROM test t LEFT JOIN item_bias USING (item_id) LEFT JOIN user_bias USING (user_id)""", **SIDES, item_bias=BIAS_SQL,
    user_bias=f"""SELECT user_id, sum(rating - (SELECT avg(rating) FROM train) - b_i) / (count(*) + {factors.USER_DAMP}::DOUBLE) AS b_u
        FROM train JOIN item_bias USING (item_id) GROUP BY user_id"""))
def baseline_predictions(spark, folder):
    train, test = sides(spark, folder)
    return rounded(factors.with_baseline(test, factors.biases(train)).select(
        "user_id", "item_id", "rating", clip_rating(F.col("baseline")).alias("prediction")))
