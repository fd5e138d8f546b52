"""The grid of neighbourhood settings against one model per setting and fold."""

from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tastegrid.operators import metrics, neighbours, search, stored
from tastegrid.session import local_session


@pytest.fixture(scope="module")
def spark():
    return local_session(cores=4, shuffle_partitions=4, memory="3g")


def test_grid_equals_single_models(spark):
    draw = random.Random(4)
    cells = {(draw.randrange(18), draw.randrange(15)): float(draw.randrange(1, 6)) for _ in range(160)}
    rows = stored.written(spark.createDataFrame([(u, i, r, draw.randrange(2)) for (u, i), r in cells.items()],
                                                "user_id long, item_id long, rating double, fold int"), "grid")
    ks, kinds = (1, 3, 50), ("msd", "cosine", "pearson")
    got = {(r.kind, r.user_based, r.k): (r.rmse, r.mae) for r in search.knn_grid(rows, ks, kinds, folds=2).collect()}
    assert len(got) == 18
    for kind, side, k in (("msd", True, 1), ("msd", False, 3), ("cosine", True, 3), ("pearson", False, 50)):
        errors = []
        for fold in range(2):
            train, test = rows.where(F.col("fold") != fold).drop("fold"), rows.where(F.col("fold") == fold).drop("fold")
            found = neighbours.knn_predictions(train, test, k, kind, side)
            errors.append(found.agg(metrics.rmse().alias("rmse"), metrics.mae().alias("mae")).first())
        assert got[kind, side, k][0] == pytest.approx(sum(e.rmse for e in errors) / 2)
        assert got[kind, side, k][1] == pytest.approx(sum(e.mae for e in errors) / 2)


def test_ratings_meet_once_per_side(spark):
    rows = stored.written(spark.createDataFrame([(1, 2, 3.0, 0), (2, 2, 4.0, 1)],
                                                "user_id long, item_id long, rating double, fold int"), "two")
    assert search.knn_grid(rows, (2,), ("msd",), folds=2).count() == 2
    assert search.knn_grid(rows.where("false"), (2,), ("msd",), folds=2).count() == 0


def test_hot_ids_in_parts_change_nothing(spark, monkeypatch):
    """An id with more co-ratings than a bucket takes is cut into parts, and the parts' neighbours are ranked together."""
    draw = random.Random(9)
    cells = {(draw.randrange(1, 16), draw.randrange(12)): float(draw.randrange(1, 6)) for _ in range(120)}
    cells |= {(0, i): float(i % 5 + 1) for i in range(12)}
    rows = stored.written(spark.createDataFrame([(u, i, r, draw.randrange(2)) for (u, i), r in cells.items()],
                                                "user_id long, item_id long, rating double, fold int"), "hot")
    train, test = rows.where("fold = 0"), rows.where("fold = 1")

    def found():
        grid = search.knn_grid(rows, (1, 2, 50), ("msd", "pearson"), folds=2).collect()
        known = neighbours.knn_predictions(train, test, 2, centred=True).collect()
        sims = neighbours.similarities(train, test, "user_id", "item_id", "cosine").collect()
        return ([(r.kind, r.user_based, r.k, round(r.rmse, 9), round(r.mae, 9)) for r in sorted(grid)],
                [(r.user_id, r.item_id, round(r.prediction, 9)) for r in sorted(known)], sorted(sims))

    whole = found()
    monkeypatch.setattr(neighbours, "PAIRS", 20)
    monkeypatch.setattr(neighbours, "LIST_ROWS", 3)
    assert found() == whole


def test_pairs_are_not_shuffled_one_by_one(spark):
    """Lists of raters travel to the id that asks, and its sums are formed there."""
    rows = spark.createDataFrame([(1, 2, 3.0), (2, 2, 4.0), (2, 3, 4.0)], "user_id long, item_id long, rating double")
    plan = neighbours.similarities(rows, rows, "user_id", "item_id", k=1)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(a#\d+L?, b#", plan)


def test_lists_travel_packed(spark):
    """Rows of a bucket are packed before the shuffle, and opened they are what they were."""
    draw = random.Random(11)
    cells = {(draw.randrange(-9, 30), draw.randrange(20)): draw.choice([1.0, 4.0, 2.5, None]) for _ in range(200)}
    rows = stored.written(spark.createDataFrame([(i, u, r, draw.choice([0, 1, None])) for (u, i), r in cells.items()],
                                                "over int, a long, x double, fa int"), "packed")
    lists = rows.withColumnsRenamed({"a": "b", "x": "y", "fa": "fb"})
    met = neighbours.with_raters(rows, lists, 100)
    assert met.rows.columns == ["bucket", "_parts", "packed"]
    got = met.opened(met.rows.toArrow())
    assert got.schema.field("over").type == pa.int32() and got.schema.field("fa").type == pa.int32()
    order = lambda x: sorted(x, key=repr)
    pairs = order((r["over"], r["a"], r["x"], r["fa"], *one) for r in got.to_pylist()
                  for one in zip(r["b"], r["y"], r["fb"], strict=True))
    assert pairs == order(map(tuple, rows.join(lists, "over").select("over", "a", "x", "fa", "b", "y", "fb").collect()))
    # fewer pairs at a time change nothing, and ids that are no numbers travel as they are
    text = neighbours.with_raters(*[f.withColumn(c, F.col(c).cast("string")) for f, c in ((rows, "a"), (lists, "b"))], 100)
    assert "packed" not in text.rows.columns
    assert order((r["over"], int(r["a"]), int(b)) for r in text.rows.toArrow().to_pylist() for b in r["b"]) == order(
        (o, a, b) for o, a, _, _, b, _, _ in pairs)


def test_only_errors_leave_a_bucket(spark):
    """No prediction is shuffled, and a rating without a user or an item gets the mean of the other folds."""
    rows = stored.written(spark.createDataFrame([(1, 2, 3.0, 0), (2, 2, 4.0, 1), (None, 2, 1.0, 0), (3, None, 5.0, 1)],
                                                "user_id long, item_id long, rating double, fold int"), "lone")
    grid = search.knn_grid(rows, (2,), ("msd",), folds=2)
    assert not re.search(r"hashpartitioning\(a#\d+L?, over#", grid._jdf.queryExecution().executedPlan().toString())
    squares = [(3 - 4.5) ** 2 + (1 - 4.5) ** 2, (4 - 2.0) ** 2 + (5 - 2.0) ** 2]
    want = sum((s / 2) ** 0.5 for s in squares) / 2
    assert [r.rmse for r in grid.collect()] == [pytest.approx(want)] * 2


def test_models_of_one_likeness_share_their_neighbours(spark):
    rows = spark.createDataFrame([(1, 1, 5.0), (1, 2, 4.0), (2, 1, 5.0), (2, 2, 3.0), (3, 1, 4.0)], "user_id long, item_id long, rating double")
    asked = spark.createDataFrame([(3, 2)], "user_id long, item_id long")
    near = stored.written(neighbours.nearest(rows, asked, 2, "msd"), "near")
    for centred in (False, True):
        assert neighbours.knn_predictions(rows, asked, 2, "msd", True, centred, near).collect() == \
            neighbours.knn_predictions(rows, asked, 2, "msd", True, centred).collect()
