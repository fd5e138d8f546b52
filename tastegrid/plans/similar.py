"""Nearest items by cosine and the rating matrix (RC13, RC14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastegrid.operators import encode, nearest, pivot, stored
from tastegrid.plans.registry import registered
from tastegrid.plans.twin import over
from tastegrid.sources import domain


def embeddings(spark, folder):
    """(vec_id, vec) of length 1."""
    return nearest.unit_vectors(domain.table(spark, folder, "embeddings"), "vec_id", "embedding")


def asked(vectors):
    """The query set: ids divisible by 100."""
    return vectors.where(F.col("vec_id") % 100 == 0)


@registered("rc14_nearest_exact", """
    WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
    s AS (SELECT a.vec_id, b.vec_id AS neighbour, round(list_cosine_similarity(a.e, b.e), 9) AS cosine
          FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0)
    SELECT vec_id, pos::INT AS pos, neighbour, round(cosine, 6) AS cosine FROM (
        SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY cosine DESC, neighbour) AS pos FROM s) WHERE pos <= 10""")
def nearest_exact(spark, folder):
    vectors = stored.written(embeddings(spark, folder), "unit-vectors")
    return nearest.nearest_exact(vectors, asked(vectors), "vec_id").withColumn("cosine", F.round("cosine", 6))


# centres start from random rows, so the cells have no SQL twin; tests measure the recall
@registered("rc14_nearest_by_cells", None)
def nearest_by_cells(spark, folder):
    vectors = stored.written(embeddings(spark, folder), "unit-vectors")
    return nearest.nearest_by_cells(vectors, vectors, "vec_id").withColumn("cosine", F.round("cosine", 6))


@registered("rc14_recall_of_cells", None)
def recall_of_cells(spark, folder):
    vectors = stored.written(embeddings(spark, folder), "unit-vectors")
    exact = nearest.nearest_exact(vectors, asked(vectors), "vec_id")
    return nearest.recall(nearest.nearest_by_cells(vectors, asked(vectors), "vec_id"), exact, "vec_id")


def rows(spark, folder):
    """The sparse rating rows and the item numbers, in the order of the hashed ids."""
    ratings = stored.written(domain.ratings(spark, folder), "ratings")
    numbers = stored.written(encode.id_map(ratings, "item_id"), "item-numbers")
    return pivot.sparse_rows(ratings, numbers, many=ratings.count()), numbers


NUMBERS = """SELECT item_id, row_number() OVER (ORDER BY md5(item_id::VARCHAR), item_id) - 1 AS idx
    FROM (SELECT DISTINCT item_id FROM ratings)"""


@registered("rc13_sparse_rows", over("ratings", """
    SELECT user_id, (idx // 4096)::BIGINT AS part, count(*)::INT AS n,
           string_agg(idx || ':' || rating, ',' ORDER BY idx) AS entries
    FROM ratings JOIN numbers USING (item_id) GROUP BY ALL""", numbers=NUMBERS))
def sparse_rows(spark, folder):
    found, _ = rows(spark, folder)
    shown = F.array_join(F.zip_with("idx", "rating", lambda i, r: F.concat_ws(":", i.cast("string"), r.cast("string"))), ",")
    return found.select("user_id", "part", "n", shown.alias("entries"))


@registered("rc13_unpivoted", over("ratings", "SELECT user_id, item_id, rating FROM ratings"))
def unpivoted(spark, folder):
    return pivot.unpivoted(*rows(spark, folder))


@registered("rc13_user_products", over("ratings", """
    SELECT a.user_id AS a, b.user_id AS b, sum(a.rating * b.rating) AS sxy, count(*) AS n
    FROM ratings a JOIN ratings b ON a.item_id = b.item_id AND a.user_id <> b.user_id
    GROUP BY ALL"""))
def user_products(spark, folder):
    """Every user against all others."""
    return pivot.user_products(stored.written(rows(spark, folder)[0], "rating-rows"))
