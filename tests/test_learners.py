"""Implicit factors and forests on planted data."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastegrid.operators import factors, forest, implicit_factors, metrics, stored
from tastegrid.session import local_session


@pytest.fixture(scope="module")
def spark():
    return local_session(cores=4, shuffle_partitions=4, memory="3g")


def rmse(frame):
    return frame.agg(metrics.rmse()).first()[0]


@pytest.fixture(scope="module")
def chosen(spark):
    """What users rate tells their taste: fans of a side rate its items more often, and score by side.

    Most users have few ratings, so their own vector cannot tell.
    """
    draw = random.Random(9)
    rows = []
    for u in range(500):
        side = u % 2
        for i in draw.sample(range(60), 14):
            if draw.random() < (0.75 if i % 2 == side else 0.12):
                liked = i < 30 if side else i >= 30
                rows.append((u, i, float(min(5, max(1, round((4.5 if liked else 1.8) + draw.gauss(0, 0.4)))))))
    frame = stored.written(spark.createDataFrame(rows, "user_id long, item_id long, rating double"), "chosen")
    test = F.pmod(F.xxhash64("user_id", "item_id"), F.lit(4)) == 0
    return frame.where(~test), frame.where(test)


def test_implicit_sets_beat_plain_factors(chosen):
    train, test = chosen
    settings = implicit_factors.Settings(no_components=4, epochs=25, learning_rate=0.1)
    implicit = rmse(implicit_factors.implicit_predictions(train, test, settings, alpha=0.01))
    plain = rmse(factors.biased_predictions(train, test, rank=4))
    base = rmse(factors.with_baseline(test, factors.biases(train)).withColumnRenamed("baseline", "prediction"))
    assert implicit < plain and implicit < 0.9 * base, (implicit, plain, base)


def test_one_round_by_hand(spark):
    """The first step moves each part against the sign of its gradient, by the learning rate."""
    cells = {(1, 1): 5.0, (1, 2): 1.0, (2, 1): 4.0, (3, 2): 2.0}
    rows = spark.createDataFrame([(u, i, r) for (u, i), r in cells.items()], "user_id long, item_id long, rating double")
    start = implicit_factors.Settings(no_components=2, epochs=0, learning_rate=0.01)
    before, after = (implicit_factors.fit(rows, implicit_factors.Settings(no_components=2, epochs=e, learning_rate=0.01), 0.0)
                     for e in (0, 1))
    q0, q1 = ({r.item_id: np.array([*r.q, r.b_i]) for r in m.items.collect()} for m in (before, after))
    z0 = {r.user_id: np.array([*r.z, r.b_u]) for r in before.users.collect()}
    assert before.mean == 3.0 and start.epochs == 0
    error = {(u, i): 3.0 + z0[u][2] + q0[i][2] + z0[u][:2] @ q0[i][:2] - r for (u, i), r in cells.items()}
    for item in (1, 2):
        raters = [u for u, i in cells if i == item]
        grad = np.mean([error[u, item] * np.array([*z0[u][:2], 1.0]) for u in raters], axis=0)
        assert np.allclose(q1[item], q0[item] - 0.01 * grad / np.sqrt(1e-6 + grad ** 2))


def test_no_ratings_and_unknown_ids(spark, chosen):
    none = spark.createDataFrame([], "user_id long, item_id long, rating double")
    empty = implicit_factors.fit(none, implicit_factors.Settings(no_components=2, epochs=1))
    asked = spark.createDataFrame([(1, 2, 3.0), (None, None, 1.0)], none.schema)
    assert [r.prediction for r in empty.predict(asked).collect()] == [3.0, 3.0]
    few = implicit_factors.fit(chosen[0].limit(50), implicit_factors.Settings(no_components=2, epochs=1))
    assert few.predict(spark.createDataFrame([(-1, -1, 3.0)], none.schema)).first().prediction == pytest.approx(few.mean)


@pytest.fixture(scope="module")
def ruled(spark):
    """The label is a rule on ``size`` and ``kind``; two numbers are noise."""
    draw = random.Random(6)
    rows = []
    for i in range(1200):
        size, kind = draw.random(), draw.choice(["a", "b", None, "z"])
        rows.append((i, size, draw.random(), None if i % 11 == 0 else draw.random(), kind, int(size > .6 or kind == "b")))
    rows += [(5000, .5, .5, .5, "a", None)]
    frame = spark.createDataFrame(rows, "id long, size double, noise double, more double, kind string, label int")
    out, names = forest.encoded(frame, "id", "label", ["size", "noise", "more"], {"kind": ["a", "b"]})
    out = stored.written(out, "ruled")
    return out.where("id % 4 <> 0"), out.where("id % 4 = 0"), names


def test_forest_finds_the_rule(spark, ruled):
    train, test, names = ruled
    assert names == ["size", "noise", "more", "kind_a", "kind_b"] and train.count() + test.count() == 1200
    model = forest.fit(train)
    report = {r.label: r for r in metrics.classification_report(forest.predicted(model, test), "label", "prediction").collect()}
    assert report[1.0].precision > .97 and report[1.0].recall > .97
    shares = {r.feature: r.importance for r in forest.importances(model, names, spark).collect()}
    assert sum(shares.values()) == pytest.approx(1) and min(shares["size"], shares["kind_b"]) > max(
        shares["noise"], shares["more"], shares["kind_a"])


def test_permutation_importances(spark, ruled):
    train, test, names = ruled
    model = forest.fit(train)
    first, again = (forest.permutation_importances(model, test.repartition(n), "id", names).collect() for n in (2, 7))
    assert first == again
    found = {r.feature: r.importance for r in first}
    assert first[0].feature == "size" and found["size"] > .2 and found["kind_b"] > .05
    assert all(abs(found[n]) < .03 for n in ("noise", "more"))
    assert forest.permutation_importances(model, test.limit(0), "id", names).count() == 0
