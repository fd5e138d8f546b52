"""Hybrid ranker and blocked scoring on planted and literal tables."""

from __future__ import annotations

import random
import tracemalloc
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tastegrid.operators import hybrid, metrics, serving, stored
from tastegrid.session import local_session, scratch_path

SIDES = 4
ITEMS = 120


@pytest.fixture(scope="module")
def spark():
    return local_session(cores=4, shuffle_partitions=4, memory="3g")


@pytest.fixture(scope="module")
def planted(spark):
    """Users like items of one of four genres; popularity is the same in all, and item 'i119' is never touched."""
    draw = random.Random(7)
    features = [(f"i{i}", name, 1 / 3) for i in range(ITEMS) for name in (f"id:i{i}", f"genre:{i % SIDES}", f"noise:{i % 7}")]
    likes = []
    for u in range(240):
        for i in draw.sample(range(ITEMS - 1), 60):
            if draw.random() < (0.35 if i % SIDES == u % SIDES else 0.02):
                likes.append((f"u{u}", f"i{i}"))
    frame = spark.createDataFrame(likes, "user_id string, item_id string").withColumn(
        "t", F.pmod(F.xxhash64("user_id", "item_id"), F.lit(4)) == 0)
    frame = stored.written(frame, "planted")
    return (frame.where("not t").drop("t"), frame.where("t").drop("t"),
            stored.written(spark.createDataFrame(features, "item_id string, feature string, weight double"), "features"))


SETTINGS = hybrid.Settings(no_components=8, epochs=12, learning_rate=0.1, item_alpha=1e-4)


@pytest.fixture(scope="module")
def model(planted):
    train, _, features = planted
    return hybrid.fit(train, features, SETTINGS, bucket_rows=300)


def scores(model, features):
    users = {r.user_id: np.array(r.vec) for r in model.users.collect()}
    items = {r.item_id: np.array(r.vec) for r in model.items(features).collect()}
    return users, items


def test_ranker_beats_popularity_and_chance(planted, model):
    train, test, features = planted
    ranks = serving.ranks_among_all(model.users, model.items(features), test, "user_id", "item_id")
    auc = metrics.auc(ranks, "user_id").agg(F.avg("auc")).first()[0]
    precision = metrics.precision_at_k(ranks, "user_id", 10).agg(F.avg("precision")).first()[0]
    popular = [r[0] for r in train.groupBy("item_id").count().orderBy(F.desc("count"), "item_id").limit(10).collect()]
    by_popularity = (test.groupBy("user_id").agg((F.sum(F.col("item_id").isin(popular).cast("int")) / 10).alias("p"))
                     .agg(F.avg("p")).first()[0])
    assert auc > 0.75 and precision > 1.5 * by_popularity, (auc, precision, by_popularity)


def test_untouched_item_is_ranked_by_its_features(planted, model):
    _, _, features = planted
    users, items = scores(model, features)
    side = (ITEMS - 1) % SIDES
    value = {u: float(v @ items[f"i{ITEMS - 1}"]) for u, v in users.items()}
    own = np.mean([v for u, v in value.items() if int(u[1:]) % SIDES == side])
    assert own > np.mean([v for u, v in value.items() if int(u[1:]) % SIDES != side]) + 0.5


def test_item_alpha_shrinks_features(planted):
    train, _, features = planted
    sizes = []
    for alpha in (0.0, 5.0):
        fitted = hybrid.fit(train, features, replace(SETTINGS, epochs=4, item_alpha=alpha))
        sizes.append(fitted.features.agg(F.avg(serving.length("vec"))).first()[0])
    assert sizes[1] < sizes[0]


def test_adadelta_and_repeats(planted):
    train, _, features = planted
    settings = replace(SETTINGS, epochs=3, learning_schedule="adadelta")
    first, again = (hybrid.fit(train.repartition(n), features, settings) for n in (2, 5))
    a, b = scores(first, features)[0], scores(again, features)[0]
    assert a.keys() == b.keys() and all(np.allclose(a[u], b[u]) for u in a)
    with pytest.raises(ValueError):
        hybrid.Settings(learning_schedule="none")


def test_one_bucket_by_hand():
    """Gradients of a bucket with two users, two liked and two drawn items."""
    settings = hybrid.Settings(no_components=1, max_sampled=1)
    pairs = pa.table({"bucket": pa.array([0, 0, 0]), "user_id": ["a", "a", "b"], "item_id": ["x", "y", "x"]})
    vec = {"a": [1.0, 0.0], "b": [-1.0, 0.0], "x": [0.5, 0.25], "y": [5.0, 0.0], "z": [0.25, 0.0]}
    rows = [(0, "a"), (0, "b"), (1, "x"), (1, "y"), (2, "z")]
    vectors = pa.table({"kind": [k for k, _ in rows], "id": [i for _, i in rows], "vec": [vec[i] for _, i in rows]})
    out = hybrid.pair_gradients(settings, 101, 0)(pairs, vectors).to_pylist()
    got = {(r["is_user"], r["id"]): (r["grad"], r["n"]) for r in out}
    # (a, x): 0.75 against 0.25 is within the margin; (a, y): 5 is not; (b, x): -0.25 against -0.25 is
    w = np.log(100)
    want = {(True, "a"): ([w * (0.25 - 0.5), 0.0], 1), (True, "b"): ([w * (0.25 - 0.5), 0.0], 1),
            (False, "x"): ([-w * (1.0 - 1.0), -2 * w], 2), (False, "z"): ([w * (1.0 - 1.0), 2 * w], 2)}
    assert got.keys() == want.keys()
    for key, (grad, n) in want.items():
        assert np.allclose(got[key][0], grad) and got[key][1] == n
    # an item the user likes is no draw for that user
    rows = [(0, "a"), (0, "b"), (1, "x"), (1, "y"), (2, "y")]
    vectors = pa.table({"kind": [k for k, _ in rows], "id": [i for _, i in rows], "vec": [vec[i] for _, i in rows]})
    out = hybrid.pair_gradients(settings, 101, 0)(pairs, vectors).to_pylist()
    assert {r["id"] for r in out if r["is_user"]} == set()


def test_empty_tables_and_nulls(spark):
    likes = spark.createDataFrame([], "user_id string, item_id string")
    features = spark.createDataFrame([], "item_id string, feature string, weight double")
    empty = hybrid.fit(likes, features, SETTINGS)
    assert empty.users.count() == 0 and empty.items(features).count() == 0
    likes = spark.createDataFrame([("u", "i"), ("u", "i"), (None, "i"), ("u", None), ("u", "unknown")], likes.schema)
    features = spark.createDataFrame([("i", "f", 1.0), ("i", "f", 1.0), ("j", "f", 0.5), (None, "f", 1.0), ("j", None, 1.0)],
                                     features.schema)
    small = hybrid.fit(likes, features, replace(SETTINGS, epochs=2))
    assert [r.user_id for r in small.users.collect()] == ["u"]
    assert sorted(r.item_id for r in small.items(features).where("item_id is not null").collect()) == ["i", "j"]


def literal(spark, users=37, items=200, size=5):
    rng = np.random.default_rng(3)
    u = {i: rng.normal(size=size) for i in range(users)}
    v = {100 + i: rng.normal(size=size) * rng.choice([0.1, 1, 3]) for i in range(items)}
    v[100], v[101] = v[102], v[102]  # ties
    seen = [(i, j) for i in u for j in rng.choice(list(v), 9, replace=False).tolist()]
    seen += [(0, j) for j in list(v)[3:]]  # three unseen items are left
    return (u, v, set(seen), spark.createDataFrame([(i, x.tolist()) for i, x in u.items()], "user_id long, vec array<double>"),
            spark.createDataFrame([(i, x.tolist()) for i, x in v.items()], "item_id long, vec array<double>"),
            spark.createDataFrame(seen, "user_id long, item_id long"))


@pytest.mark.parametrize(("block_items", "block_users"), [(16, 5), (1000, 1000), (70, 1)])
def test_top_scores_equal_brute_force(spark, block_items, block_users):
    u, v, seen, users, items, hidden = literal(spark)
    got = serving.top_scores(users, items, "user_id", "item_id", 5, hidden, block_items, block_users).collect()
    want = []
    for i, x in u.items():
        best = sorted((-round(float(x @ y), 9), j) for j, y in v.items() if (i, j) not in seen)[:5]
        want += [(i, pos, j) for pos, (_, j) in enumerate(best, 1)]
    assert sorted((r.user_id, r.pos, r.item_id) for r in got) == sorted(want)
    ranks = serving.ranks_among_all(users, items, hidden, "user_id", "item_id", block_items, block_users).collect()
    for r in ranks:
        order = sorted((-round(float(u[r.user_id] @ y), 9), j) for j, y in v.items())
        assert [j for _, j in order].index(r.item_id) + 1 == r.rank and r.n == len(v)


def test_short_vectors_are_not_asked(spark):
    """Blocks that cannot reach a user's k-th score are skipped, and the result stays whole."""
    u, v, _, users, items, _ = literal(spark)
    blocked, most = serving.item_blocks(items, "item_id", 16)
    assert most == sorted(most, reverse=True) and blocked.count() == len(v)
    first = serving._ask(serving.needed_blocks(users, None, "user_id", most, 5).where("ib = 0"), blocked, "user_id",
                         "item_id", 5, None, "user_id long, item_id long, score double", 10)
    asked = serving.needed_blocks(users, first, "user_id", most, 5).count()
    assert asked < len(u) * len(most)


def test_no_items_and_unknown_pairs(spark):
    _, _, _, users, items, _ = literal(spark)
    none = items.limit(0)
    assert serving.top_scores(users, none, "user_id", "item_id", 5).count() == 0
    test = spark.createDataFrame([(0, 100), (0, -1), (-1, 100)], "user_id long, item_id long")
    got = {(r.user_id, r.item_id): (r.rank, r.n) for r in serving.ranks_among_all(users, items, test, "user_id", "item_id").collect()}
    assert got[0, 100][1] == 200 and got[0, -1] == got[-1, 100] == (None, None)


def test_saved_model_serves_the_same(spark, planted, model):
    train, _, features = planted
    path = scratch_path(spark, "model")
    hybrid.save(model, features, train, path)
    top = lambda served: sorted((r.user_id, r.pos, r.item_id) for r in served.recommend(k=5).collect())
    direct = hybrid.Served(model.users, model.items(features), train, model)
    other = spark.newSession()
    loaded = hybrid.load(other, path)
    assert top(loaded) == top(direct) and loaded.model.settings == SETTINGS
    seen = {(r.user_id, r.item_id) for r in train.collect()}
    assert not seen & {(u, i) for u, _, i in top(loaded)}
    stored.remove(spark, f"{path}/about")
    with pytest.raises(Exception):
        hybrid.load(other, path)


def test_trials_go_on_where_they_stopped(spark):
    from tastegrid.operators import ranking, trials

    settings = trials.grid(rate=[0.1, 0.5], epochs=[1, 2, 3])
    ran: list = []

    def work(stop_at):
        def one(open_):
            for s in open_:
                if len(ran) == stop_at:
                    raise RuntimeError("driver lost")
                ran.append(s)
                yield s, {"precision": s["rate"] * s["epochs"]}
        return one

    groups = [settings[:3], settings[3:]]
    schema = "rate double, epochs int, precision double"
    ledger = scratch_path(spark, "trials")
    with pytest.raises(RuntimeError):
        trials.run(spark, ledger, groups, work(2), schema)
    table = trials.run(spark, ledger, groups, work(None), schema)
    assert ran == settings
    assert {(r.rate, r.epochs): r.precision for r in table.collect()} == {
        (s["rate"], s["epochs"]): s["rate"] * s["epochs"] for s in settings}
    assert trials.run(spark, ledger, groups, work(6), schema).count() == 6
    best = ranking.best_by(table, "precision", "rate").first()
    assert (best.rate, best.epochs) == (0.5, 3)


def test_marks_are_the_shorter_fits(planted):
    train, _, features = planted
    settings = replace(SETTINGS, epochs=2)
    found = {e: scores(m, features)[0] for e, m in hybrid.fits(train, features, settings, (1,))}
    short = scores(hybrid.fit(train, features, replace(settings, epochs=1)), features)[0]
    assert set(found) == {1, 2} and all(np.allclose(found[1][u], short[u]) for u in short)


def test_wide_blocks_take_bounded_memory():
    """A block pair is scored in parts: the tables of all its scores never exist at once."""
    rng = np.random.default_rng(5)
    users, items = rng.normal(size=(500, 4)), rng.normal(size=(20_000, 4))
    vectors = lambda key, of, **more: pa.table({key: np.arange(len(of)), "vec": pa.array(of.tolist()), **more})
    left = vectors("user_id", users, seen=pa.array([[0]] * len(users), pa.list_(pa.int64())))
    right = vectors("item_id", items)
    tracemalloc.start()
    got = serving._best("user_id", "item_id", 3)(left, right)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.num_rows == 1500 and most < 40e6  # all scores take 80 MB, and their order as much again


def test_scores_with_many_ties():
    rng = np.random.default_rng(6)
    scores = rng.integers(0, 4, size=(7, 900)).astype(float)
    scores[0, 5:] = -np.inf
    row, column, value = serving._best_places(scores, np.full(7, -np.inf), 6)
    want = [(r, c, -v) for r in range(7) for v, c in sorted((-s, c) for c, s in enumerate(scores[r]) if s > -np.inf)[:6]]
    assert list(zip(row.tolist(), column.tolist(), value.tolist(), strict=True)) == want
    line = scores[1] + rng.choice([0, 1e-12], 900)
    for n in (3, 200):  # a pass for each, and one sort
        place = rng.choice(900, n, replace=False)
        order = {c: p for p, (_, c) in enumerate(sorted((-round(s, 9), c) for c, s in enumerate(line)))}
        assert serving._above(line, np.round(line[place], 9), place).tolist() == [order[c] for c in place.tolist()]


@pytest.mark.parametrize("kind", ["plain", "whole", "twins", "wide"])
def test_ranks_in_single_precision_are_exact(monkeypatch, kind):
    """Counts are those of doubles, and only where many scores are too near are whole lines of doubles formed."""
    rng = np.random.default_rng(8)
    users, items = rng.normal(size=(70, 5)), rng.normal(size=(3_000, 5))
    if kind == "whole":
        users, items = np.round(users), np.round(items)
    elif kind == "twins":  # next to each other beyond single precision, some beyond the digits compared
        items[1_000:2_000] = items[:1_000] + 1e-8
        items[2_000:] = items[:1_000] + 1e-12
    elif kind == "wide":
        users, items = users * 1e20, items * 1e20
    sizes = rng.integers(0, 5, 70)
    sizes[3] = 40  # one sort for many
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    who, place = np.repeat(np.arange(70), sizes), rng.integers(0, 3_000, sizes.sum())
    at = np.round(np.einsum("ij,ij->i", users[who], items[place]), 9)
    scores = users @ items.T
    want = [serving._above(scores[u], at[t:t + 1], place[t:t + 1])[0] for t, u in enumerate(who)]
    lines = []
    above = serving._above
    monkeypatch.setattr(serving, "_above", lambda *a: lines.append(1) or above(*a))
    monkeypatch.setattr(serving, "TILE_ITEMS", 700)
    assert serving._many_above(users, items, at, place, offsets).tolist() == want
    assert bool(lines) == (kind in ("whole", "wide"))


@pytest.mark.parametrize("kind", ["plain", "whole", "twins", "wide"])
def test_best_in_single_precision_are_exact(monkeypatch, kind):
    """The best of all tiles are those of doubles, ties by item; only beyond single precision are all scores doubles."""
    rng = np.random.default_rng(9)
    users, items = rng.normal(size=(70, 5)), rng.normal(size=(3_000, 5))
    if kind == "whole":
        users, items = np.round(users), np.round(items)
    elif kind == "twins":
        items[1_000:2_000] = items[:1_000] + 1e-8
        items[2_000:] = items[:1_000] + 1e-12
    elif kind == "wide":
        users, items = users * 1e20, items * 1e20
    scores = users @ items.T
    hidden = [sorted(rng.choice(np.argsort(-line)[:40], rng.integers(0, 9), replace=False).tolist()) for line in scores]
    hidden[0] = list(range(2_997))  # three items are left
    bar = np.full(70, -np.inf)
    want = []
    for u, line in enumerate(scores):
        order = sorted((-round(float(s), 9), i) for i, s in enumerate(line) if i not in hidden[u])[:4]
        bar[u] = -order[-1][0] if u % 2 else -np.inf  # a bar may be met
        want += [(u, i) for _, i in order]
    left = pa.table({"user_id": np.arange(70), "vec": pa.array(users.tolist()), "seen": pa.array(hidden, pa.list_(pa.int64())),
                     "_bar": bar})
    right = pa.table({"item_id": np.arange(3_000), "vec": pa.array(items.tolist())}).take(pa.array(rng.permutation(3_000)))
    doubles = []
    places = serving._best_places
    monkeypatch.setattr(serving, "_best_places", lambda *a: doubles.append(1) or places(*a))
    monkeypatch.setattr(serving, "TILE_ITEMS", 700)
    got = serving._best("user_id", "item_id", 4)(left, right)
    assert list(zip(got["user_id"].to_pylist(), got["item_id"].to_pylist(), strict=True)) == want
    assert bool(doubles) == (kind == "wide")


def test_whole_numbers_are_ranked_without_doubles(monkeypatch):
    rng = np.random.default_rng(10)
    users, items = rng.integers(0, 5, (70, 6)).astype(float), rng.integers(0, 2, (3_000, 6)).astype(float)
    who, place = np.repeat(np.arange(70), 3), rng.integers(0, 3_001, 210)
    at = np.einsum("ij,ij->i", users[who], items[np.minimum(place, 2_999)])
    scores = users @ items.T
    want = [serving._above(scores[u], at[t:t + 1], place[t:t + 1])[0] for t, u in enumerate(who)]
    monkeypatch.setattr(serving, "TILE_ITEMS", 700)
    monkeypatch.setattr(serving, "_above", None)  # lines of doubles are not asked for
    assert serving._many_above(users, items, at, place, np.arange(71) * 3).tolist() == want
