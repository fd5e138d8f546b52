"""Rating models, rankings and metrics against brute force on literal tables."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tastegrid.operators import metrics, neighbours, recommend
from tastegrid.session import local_session


@pytest.fixture(scope="module")
def spark():
    return local_session(cores=4, shuffle_partitions=4, memory="3g")


def sample_ratings(seed: int = 1):
    rng = random.Random(seed)
    rows = {(u, i): float(rng.randint(1, 5)) for u in range(12) for i in rng.sample(range(10), 5)}
    rows |= {(u, 99): float(1 + u % 5) for u in range(12)}  # an item that everybody rated
    return rows


def test_blocks_lose_no_pair_and_keep_blocks_small(spark):
    left = spark.createDataFrame([(1, u) for u in range(40)] + [(2, 7), (3, 1)], "key int, a int")
    right = spark.createDataFrame([(1, u) for u in range(30)] + [(2, 8), (4, 1)], "key int, b int")
    got = neighbours.in_blocks(left, right, "key", "a", "b", block_rows=8)
    assert sorted(map(tuple, got.select("key", "a", "b").collect())) == sorted(
        map(tuple, left.join(right, "key").select("key", "a", "b").collect()))


@pytest.mark.parametrize("kind", ["msd", "cosine", "pearson"])
def test_similarities(spark, kind):
    rows = sample_ratings()
    frame = spark.createDataFrame([(u, i, r) for (u, i), r in rows.items()], "user_id int, item_id int, rating double")
    got = {(r.a, r.b): r.sim for r in neighbours.similarities(
        frame, frame.where("user_id < 3"), "user_id", "item_id", kind).collect()}
    items = {i for _, i in rows}
    for a in range(3):
        for b in range(12):
            pairs = [(rows[a, i], rows[b, i]) for i in items if (a, i) in rows and (b, i) in rows]
            if a == b or not pairs:
                assert (a, b) not in got
                continue
            n = len(pairs)
            if kind == "msd":
                want = 1 / (sum((x - y) ** 2 for x, y in pairs) / n + 1)
            elif kind == "cosine":
                want = sum(x * y for x, y in pairs) / math.sqrt(
                    sum(x * x for x, _ in pairs) * sum(y * y for _, y in pairs))
            else:
                mx, my = sum(x for x, _ in pairs) / n, sum(y for _, y in pairs) / n
                vx, vy = sum((x - mx) ** 2 for x, _ in pairs), sum((y - my) ** 2 for _, y in pairs)
                want = sum((x - mx) * (y - my) for x, y in pairs) / math.sqrt(vx * vy) if n > 1 and vx * vy > 1e-9 else None
            assert got[a, b] == (None if want is None else pytest.approx(want))
    assert len({a for a, _ in got}) == 3


def test_without_neighbours_the_mean_holds_and_predictions_stay_on_the_scale(spark):
    train = spark.createDataFrame([(1, 1, 5.0), (1, 2, 4.0), (2, 1, 5.0)], "user_id int, item_id int, rating double")
    asked = spark.createDataFrame([(2, 2), (7, 7), (2, 7)], "user_id int, item_id int")
    plain = {(r.user_id, r.item_id): r.prediction for r in neighbours.knn_predictions(train, asked).collect()}
    assert plain == {(2, 2): 4.0, (7, 7): pytest.approx(14 / 3), (2, 7): pytest.approx(14 / 3)}
    centred = {(r.user_id, r.item_id): r.prediction
               for r in neighbours.knn_predictions(train, asked, centred=True).collect()}
    assert centred == {(2, 2): 4.5, (7, 7): pytest.approx(14 / 3), (2, 7): 5.0}
    assert neighbours.knn_predictions(train, asked.where("false")).count() == 0
    assert neighbours.knn_predictions(train.where("false"), asked).where("prediction is null").count() == 3


@pytest.mark.parametrize("exclude", [False, True])
def test_ranking_metrics_and_top_unseen(spark, exclude):
    rng = random.Random(3)
    group = {u: u % 2 for u in range(6)}
    score = {(g, i): float(rng.randint(0, 4)) for g in (0, 1) for i in range(12)}  # many ties
    draw = {(u, i): rng.random() for u in group for i in range(12)}
    test = {k for k, v in draw.items() if v < 0.25 and k[0] != 5} | {(0, 77)}  # 77 has no score, 5 no test item
    seen = {k for k, v in draw.items() if v > 0.6}
    table = lambda keys: spark.createDataFrame(
        [(u, group[u], i) for u, i in sorted(keys)], "user int, g int, item int")
    ranked = metrics.ranking(spark.createDataFrame([(*k, s) for k, s in score.items()], "g int, item int, s double"),
                             "g", "item", "s")
    rows = metrics.ranks_of(ranked, table(test), "g", "user", "item", table(seen) if exclude else None)
    precision = {r.user: r.precision for r in metrics.precision_at_k(rows, "user", 3).collect()}
    area = {r.user: r.auc for r in metrics.auc(rows, "user").collect()}
    tests = defaultdict(set)
    for u, i in test:
        tests[u].add(i)
    assert set(precision) == set(tests)
    for u, own in tests.items():
        order = sorted(range(12), key=lambda i: (-score[group[u], i], i))
        order = [i for i in order if not exclude or (u, i) not in seen]
        assert precision[u] == pytest.approx(sum(i in own for i in order[:3]) / 3)
        hits, rest = [i for i in order if i in own], [i for i in order if i not in own]
        if hits and rest:
            above = sum(order.index(h) < order.index(r) for h in hits for r in rest)
            assert area[u] == pytest.approx(above / (len(hits) * len(rest)))
    best = recommend.top_unseen(ranked, table({(u, 0) for u in group}), table(seen), "g", "user", "item", k=4)
    given = defaultdict(list)
    for r in best.orderBy("user", "pos").collect():
        given[r.user].append(r.item)
    for u in group:
        order = sorted(range(12), key=lambda i: (-score[group[u], i], i))
        assert given[u] == [i for i in order if (u, i) not in seen][:4]


def test_errors_and_report(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 2.0), (None, 1.0)], "rating double, prediction double")
    got = rows.agg(metrics.rmse().alias("r"), metrics.mae().alias("m")).first()
    assert (got.r, got.m) == (pytest.approx(math.sqrt(10 / 3)), pytest.approx(4 / 3))
    pairs = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (0, 2), (None, 1)], "y int, p int")
    report = {r.label: tuple(r)[1:] for r in metrics.classification_report(pairs, "y", "p").collect()}
    assert report == {0: (pytest.approx(2 / 3), pytest.approx(2 / 3), pytest.approx(2 / 3), 3),
                      1: (0.5, 0.5, 0.5, 2), 2: (0.0, 0.0, 0.0, 0)}
    assert metrics.classification_report(pairs.where("false"), "y", "p").count() == 0


def test_normal_draw_is_repeatable_and_on_the_scale(spark):
    train = spark.createDataFrame([(float(1 + i % 5),) for i in range(100)], "rating double")
    asked = spark.range(2000).withColumn("x", F.lit(1))
    one = neighbours.normal_predictions(train, asked, F.col("id"))
    two = neighbours.normal_predictions(train, asked.repartition(7), F.col("id"))
    assert one.exceptAll(two).count() == 0
    got = one.agg(F.min("prediction").alias("lo"), F.max("prediction").alias("hi"), F.avg("prediction").alias("m")).first()
    assert got.lo >= 1 and got.hi <= 5 and abs(got.m - 3) < 0.15
