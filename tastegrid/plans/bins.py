"""Bins and distributions (BK)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastegrid.functions import binning
from tastegrid.operators import aggregate, bins
from tastegrid.plans.aggregates import BAND_LABELS, BANDS, BAND_SQL, banded_users
from tastegrid.plans.registry import registered
from tastegrid.plans.twin import over
from tastegrid.sources import domain


def quantile_twin(source: str, order: str = "") -> str:
    """Deciles of ``source(n)`` as SQL."""
    return f"""
    SELECT b.bucket, lo, hi, coalesce(c."count", 0)::BIGINT AS "count" FROM (
        SELECT unnest(range(1, greatest(len(e), 2)))::INT AS bucket,
               unnest(CASE WHEN len(e) = 1 THEN e ELSE e[1:len(e) - 1] END) AS lo,
               unnest(CASE WHEN len(e) = 1 THEN e ELSE e[2:] END) AS hi FROM edges) b
    LEFT JOIN (SELECT greatest(1, len(list_filter(e, lambda x: x < n)))::INT AS bucket, count(*) AS "count"
               FROM {source}, edges GROUP BY 1) c ON c.bucket = b.bucket {order}"""


def edges_twin(source: str) -> str:
    """Distinct decile edges of ``source(n)`` as one list."""
    return f"""SELECT list_sort(list_distinct(quantile_cont(n::DOUBLE,
               [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1]))) AS e FROM {source}"""


PRICE_SQL = """SELECT b.bucket, b.label, count(g.price_final) AS "count"
    FROM (VALUES (1, '0-10€', 0, 10), (2, '10-30€', 10, 30), (3, '30-80€', 30, 80), (4, '>80€', 80, 1e308))
         b(bucket, label, lo, hi)
    LEFT JOIN catalog g ON g.price_final >= b.lo AND g.price_final < b.hi
    GROUP BY 1, 2"""


@registered("bk1_left_closed_bins", over("catalog", PRICE_SQL))
def left_closed_bins(spark, folder):
    return bins.cut_histogram(domain.catalog(spark, folder), "price_final", binning.PRICE_EDGES,
                              binning.PRICE_LABELS, right=False)


@registered("bk2_right_closed_bins", over("interactions", """
    SELECT b.bucket, b.label, count(c.n) AS "count"
    FROM (VALUES (1, '1-2', 0, 2), (2, '3-5', 2, 5), (3, '6-20', 5, 20), (4, '20+', 20, 1e308)) b(bucket, label, lo, hi)
    LEFT JOIN (SELECT count(*) AS n FROM interactions GROUP BY user_id) c ON c.n > b.lo AND c.n <= b.hi
    GROUP BY 1, 2"""))
def right_closed_bins(spark, folder):
    counts = aggregate.count_per(domain.interactions(spark, folder), "user_id", name="n_reviews")
    return bins.cut_histogram(counts, "n_reviews", binning.ACTIVITY_EDGES, binning.ACTIVITY_LABELS)


@registered("bk2_activity_bands", over("", """SELECT user_id, n_reviews, band FROM banded""", banded=BAND_SQL))
def activity_bands(spark, folder):
    return banded_users(spark, folder)


@registered("bk3_quantile_bins", over("reviews", """
    SELECT item_id, n, greatest(1, len(list_filter(e, lambda x: x < n)))::INT AS bucket FROM counts, edges""",
    counts="SELECT item_id, count(*) AS n FROM reviews GROUP BY item_id", edges=edges_twin("counts")))
def quantile_bins(spark, folder):
    return bins.quantile_bins(aggregate.count_per(domain.reviews(spark, folder), "item_id", name="n"), "n")


@registered("bk4_bin_histogram_descending", over("", quantile_twin("counts"),
    counts="SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1", edges=edges_twin("counts")))
def bin_histogram_descending(spark, folder):
    counts = aggregate.count_per(domain.table(spark, folder, "orders"), "o_custkey", name="n")
    return bins.quantile_histogram(counts, "n", ascending=False)


NUMBERS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
           "l_discount", "l_tax")


def width_twin(source: str, column: str, n: int = 50) -> str:
    """Equal-width histogram of one column as SQL."""
    return f"""
    SELECT '{column}' AS "column", b.bucket::INT AS bucket,
           round(s.lo + (s.hi - s.lo) / {n}.0::DOUBLE * (b.bucket - 1), 6) AS lo,
           round(s.lo + (s.hi - s.lo) / {n}.0::DOUBLE * b.bucket, 6) AS hi, count(c.bucket) AS "count"
    FROM range(1, {n + 1}) b(bucket)
    CROSS JOIN (SELECT min({column})::DOUBLE AS lo, max({column})::DOUBLE AS hi FROM {source}) s
    LEFT JOIN (
        SELECT least({n}, coalesce(floor(({column}::DOUBLE - lo) / nullif(hi - lo, 0) * {n}.0::DOUBLE), 0)::INT + 1)
               AS bucket
        FROM {source}, (SELECT min({column})::DOUBLE AS lo, max({column})::DOUBLE AS hi FROM {source})
        WHERE {column} IS NOT NULL) c ON c.bucket = b.bucket GROUP BY b.bucket, s.lo, s.hi"""


@registered("bk5_equal_width_histogram", over("", width_twin("lineitem", "l_extendedprice")))
def equal_width_histogram(spark, folder):
    table = bins.width_histogram(domain.table(spark, folder, "lineitem"), "l_extendedprice")
    return table.withColumns({c: F.round(c, 6) for c in ("lo", "hi")})


@registered("bk6_month_histogram", """
    SELECT m::INT AS month, count(o_orderkey) AS "count" FROM range(1, 13) r(m)
    LEFT JOIN orders ON month(o_orderdate) = m GROUP BY m""")
def month_histogram(spark, folder):
    return bins.month_histogram(domain.table(spark, folder, "orders"), "o_orderdate")


@registered("bk7_histogram_of_every_column", over("", " UNION ALL ".join(
    width_twin("lineitem", c, 10) for c in NUMBERS)))
def histogram_of_every_column(spark, folder):
    table = bins.width_histogram(domain.table(spark, folder, "lineitem"), *NUMBERS, bins=10)
    return table.withColumns({c: F.round(c, 6) for c in ("lo", "hi")})


@registered("bk8_scatter_data", over("games", """
    SELECT item_id, price_final, positive_ratio FROM games
    WHERE price_final IS NOT NULL AND positive_ratio IS NOT NULL"""))
def scatter_data(spark, folder):
    return (domain.games(spark, folder).select("item_id", "price_final", "positive_ratio")
            .na.drop(subset=["price_final", "positive_ratio"]))


@registered("bk8_scatter_grid", over("games", """
    SELECT floor(price_final / 5.0::DOUBLE) * 5.0::DOUBLE AS price_final,
           floor(positive_ratio::DOUBLE / 2.0::DOUBLE) * 2.0::DOUBLE AS positive_ratio, count(*) AS "count"
    FROM games WHERE price_final IS NOT NULL AND positive_ratio IS NOT NULL GROUP BY 1, 2"""))
def scatter_grid(spark, folder):
    return bins.scatter_grid(domain.games(spark, folder), "price_final", "positive_ratio", 5.0, 2.0)
