"""Ratings are made once, by tasks that rise with the rows."""

from __future__ import annotations

import pytest

from tastegrid import session
from tastegrid.operators import encode, pivot
from tastegrid.plans import recommend, similar
from tastegrid.session import local_session, spread
from tastegrid.sources import domain


@pytest.fixture(scope="module")
def spark():
    return local_session(cores=4, shuffle_partitions=4, memory="3g")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Order lines with repeats, nulls, an unknown order and an order twice."""
    where = str(tmp_path_factory.mktemp("tables"))
    lines = [(o, o * 7 % 11, o % 3, n, "RAN"[(o + n) % 3], 5.0, None) for o in range(60) for n in range(4)]
    lines += lines[:9] + [(None, 1, 1, 1, "N", 5.0, None), (3, None, 1, 1, "N", 5.0, None), (4, 2, 1, 1, None, 5.0, None),
                          (999, 1, 1, 1, "N", 5.0, None)]
    kind = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_quantity double, "
            "l_shipdate timestamp")
    spark.createDataFrame(lines, kind).write.parquet(f"{where}/lineitem.parquet")
    orders = [(o, o % 13) for o in range(60)] + [(5, 2), (6, None), (None, 1)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{where}/orders.parquet")
    return where


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def plain(spark, folder):
    """The ratings, the user joined first."""
    return domain.rated(domain.interactions(spark, folder)).groupBy("user_id", "item_id").agg({"rank": "max"})


def test_spread_follows_the_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 10)
    assert spread(spark.range(200), 200, "id").rdd.getNumPartitions() == 20
    assert spread(spark.range(200, numPartitions=3), 40, "id").rdd.getNumPartitions() == 3


@pytest.mark.parametrize("task_rows", [1 << 19, 10])
def test_ratings_and_matrix(spark, folder, monkeypatch, task_rows):
    monkeypatch.setattr(session, "TASK_ROWS", task_rows)
    ratings = domain.ratings(spark, folder)
    assert ratings.schema.simpleString() == "struct<user_id:bigint,item_id:bigint,rating:double>"
    want = sorted(((u, i, float(r)) for u, i, r in plain(spark, folder).collect()), key=repr)
    assert rows_of(ratings) == want
    numbers = encode.id_map(ratings, "item_id")
    cells = pivot.sparse_rows(ratings, numbers, part_items=4, many=len(want))
    assert rows_of(pivot.unpivoted(cells, numbers)) == [r for r in want if r[1] is not None]
    if task_rows == 10:
        assert ratings.rdd.getNumPartitions() == -(-253 // 10)  # lines
        assert cells.rdd.getNumPartitions() == -(-len(want) // 10)


def test_sides_read_one_table_of_ratings(spark, folder):
    train, test = recommend.sides(spark, folder)
    assert sorted(train.inputFiles()) == sorted(test.inputFiles())
    assert not any("lineitem" in f for f in train.inputFiles())
    assert rows_of(train.unionByName(test)) == rows_of(domain.ratings(spark, folder))


def test_products_are_of_all_users(spark, folder):
    """Users whose ids are no multiples of a hundred are multiplied as well."""
    cells = {}
    for u, i, r in rows_of(domain.ratings(spark, folder)):
        if u is not None and i is not None:
            cells.setdefault(u, {})[i] = r
    want = {}
    for a in cells:
        for b in cells:
            if a != b and (both := cells[a].keys() & cells[b].keys()):
                want[a, b] = sum(cells[a][i] * cells[b][i] for i in both), len(both)
    got = {(r.a, r.b): (r.sxy, r.n) for r in similar.user_products(spark, folder).collect()}
    assert got == want and {a for a, _ in got} == cells.keys()
