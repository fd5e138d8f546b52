"""Nearest vectors and the rating matrix against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastegrid.operators import encode, nearest, neighbours, pivot, stored
from tastegrid.session import local_session


@pytest.fixture(scope="module")
def spark():
    return local_session(cores=4, shuffle_partitions=4, memory="3g")


@pytest.fixture(scope="module")
def clouds(spark):
    """1,500 vectors in 20 clouds, one cloud holding a third of them, and rows that take no part."""
    rng = np.random.default_rng(11)
    middles = rng.normal(size=(20, 12))
    cloud = np.where(rng.random(1500) < 1 / 3, 0, rng.integers(0, 20, 1500))
    values = middles[cloud] + 0.4 * rng.normal(size=(1500, 12))
    rows = [(i, v.tolist()) for i, v in enumerate(values)] + [(5000, [0.0] * 12), (None, [1.0] * 12)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return values, stored.written(nearest.unit_vectors(frame, "vec_id", "embedding"), "clouds")


def brute_force(values, i, k):
    unit = values / np.linalg.norm(values, axis=1, keepdims=True)
    cosine = np.round(unit @ unit[i], 9)
    return [j for _, j in sorted((-c, j) for j, c in enumerate(cosine) if j != i)[:k]]


def test_exact(clouds):
    values, vectors = clouds
    assert vectors.count() == 1500
    for blocks in ({}, {"block_items": 100, "block_users": 4}):
        got = nearest.nearest_exact(vectors, vectors.where("vec_id % 100 = 0"), "vec_id", 10, **blocks).collect()
        found: dict = {}
        for r in sorted(got, key=lambda r: r.pos):
            found.setdefault(r.vec_id, []).append(r.neighbour)
        assert found == {i: brute_force(values, i, 10) for i in range(0, 1500, 100)}


def test_cells_find_nine_of_ten(clouds):
    values, vectors = clouds
    asked = vectors.where("vec_id % 100 = 0")
    exact = nearest.nearest_exact(vectors, asked, "vec_id")
    found = nearest.nearest_by_cells(vectors, asked, "vec_id", block_items=64, block_users=3)
    row = nearest.recall(found, exact, "vec_id").first()
    assert row.neighbours == 150 and row.recall >= 0.9
    everywhere = nearest.nearest_by_cells(vectors, asked, "vec_id", cells=10, probes=10, block_items=64)
    assert nearest.recall(everywhere, exact, "vec_id").first().recall == 1.0


def test_empty(spark, clouds):
    _, vectors = clouds
    none = vectors.limit(0)
    assert nearest.nearest_by_cells(none, none, "vec_id").count() == 0
    assert nearest.nearest_exact(vectors, none, "vec_id").count() == 0


def test_matrix_round_trip_and_products(spark):
    rng = np.random.default_rng(5)
    cells = {(int(u), int(i)): float(rng.integers(1, 6)) for u, i in zip(rng.integers(0, 30, 400), rng.integers(0, 50, 400))}
    ratings = spark.createDataFrame([(u, i, r) for (u, i), r in cells.items()], "user_id long, item_id long, rating double")
    numbers = stored.written(encode.id_map(ratings, "item_id"), "numbers")
    rows = pivot.sparse_rows(ratings, numbers, part_items=7)
    for r in rows.collect():
        assert list(r.idx) == sorted(r.idx) and r.n == len(r.idx) <= 7 and {i // 7 for i in r.idx} == {r.part}
    assert {(r.user_id, r.item_id): r.rating for r in pivot.unpivoted(rows, numbers).collect()} == cells
    asked = ratings.where("user_id < 5")
    got = {(r.a, r.b): (r.sxy, r.n) for r in pivot.user_products(rows, asked).collect()}
    matrix = np.zeros((30, 50))
    for (u, i), v in cells.items():
        matrix[u, i] = v
    product = matrix @ matrix.T
    assert got == {(a, b): (product[a, b], int(((matrix[a] > 0) & (matrix[b] > 0)).sum()))
                   for a in range(5) for b in range(30) if a != b and product[a, b]}
    sims = {(r.a, r.b): r.sim for r in neighbours.similarities(ratings, asked, "user_id", "item_id", "cosine").collect()}
    assert sims.keys() == got.keys()
    wide = pivot.dense_pivot(ratings, [1, 2]).collect()
    assert {r.user_id: (r.item_1, r.item_2) for r in wide} == {
        u: (cells.get((u, 1)), cells.get((u, 2))) for u in {u for u, i in cells if i in (1, 2)}}
    assert pivot.sparse_rows(ratings.where(F.lit(False)), numbers).count() == 0
