"""Label columns, stacked features, split flags and asked pairs on literal rows, and their plans."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tastegrid.operators import encode, neighbours, sample
from tastegrid.session import local_session


@pytest.fixture(scope="module")
def spark():
    return local_session(cores=4, shuffle_partitions=4, memory="3g")


def plan_of(frame):
    return frame._jdf.queryExecution().toString()


def test_every_label_becomes_a_column(spark):
    labels = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (2, "new one"), (3, None)], "k long, label string")
    wide = encode.multi_hot_wide(labels, "k", "label")
    assert wide.columns == ["k", "a", "b", "new one"]
    assert sorted(map(tuple, wide.collect())) == [(1, 1, 1, 0), (2, 0, 0, 1), (3, 0, 0, 0)]
    assert encode.multi_hot_wide(labels, "k", "label", ["b", "z"]).columns == ["k", "b", "z"]
    with pytest.raises(ValueError, match="more than 2 labels"):
        encode.label_list(labels, "label", most=2)
    assert encode.label_list(labels, "label", most=3) == ["a", "b", "new one"]


def test_labels_are_attached_without_a_join(spark):
    frame = spark.createDataFrame([(1, ["b", "a", "b"], "x"), (2, [], "y"), (3, None, "z"), (4, ["c", None], None)],
                                  "k long, tags array<string>, other string")
    wide = encode.attach_labels(frame, "tags")
    assert wide.columns == ["k", "other", "a", "b", "c"]
    assert sorted(map(tuple, wide.collect()), key=str) == [
        (1, "x", 1, 1, 0), (2, "y", 0, 0, 0), (3, "z", 0, 0, 0), (4, None, 0, 0, 1)]
    assert "Join" not in plan_of(wide)
    assert encode.attach_labels(frame.where("k = 2"), "tags").columns == ["k", "other"]


def test_stacked_features(spark):
    """Keys that every part has; a key whose values are all null still counts as a part's."""
    schema = "k long, feature string, value double"
    facts = spark.createDataFrame([(1, "f", 0.0), (2, "f", None), (3, "f", 2.0), (None, "f", 1.0)], schema)
    tags = spark.createDataFrame([(1, "t", 1.0), (2, "t", 1.0), (2, "u", 1.0), (4, "t", 1.0), (None, "t", 1.0)], schema)
    both = encode.stacked_features([facts, tags], "k")
    assert sorted(map(tuple, both.collect())) == [(1, "f", 0.0), (1, "t", 1.0), (2, "t", 1.0), (2, "u", 1.0)]
    assert "Join" not in plan_of(both)
    assert encode.stacked_features([facts, tags.where("false")], "k").count() == 0


def test_split_flag_agrees_with_the_two_sides(spark):
    frame = spark.range(400).select(F.when(F.col("id") % 50 > 0, F.col("id")).alias("k"))
    train, test = sample.split(frame, F.col("k").cast("string"), 0.3)
    flagged = sample.with_split(frame, F.col("k").cast("string"), 0.3)
    for side, flag in ((train, "NOT is_test"), (test, "is_test")):
        assert sorted(r.k or -1 for r in side.collect()) == sorted(r.k or -1 for r in flagged.where(flag).collect())
    assert flagged.where("k IS NULL AND NOT is_test").count() == 8


@pytest.mark.parametrize("block_rows", [4096, 2])
def test_only_wanted_pairs_are_summed(spark, block_rows, monkeypatch):
    draw = random.Random(5)
    rows = [(u, i, draw.randint(1, 5)) for u in range(25) for i in range(20) if draw.random() < 0.5 or i == 0]
    ratings = spark.createDataFrame(rows, "user_id long, item_id long, rating int")
    asked = ratings.where("user_id < 6").select("user_id").distinct()
    wanted = spark.createDataFrame([(0, 7), (0, 8), (5, 0), (5, 5), (3, 99), (0, 7)], "a long, b long")
    whole = neighbours.in_blocks
    monkeypatch.setattr(neighbours, "in_blocks", lambda *a: whole(*a, block_rows=block_rows))
    for kind in ("msd", "cosine", "pearson"):
        every = {(r.a, r.b): (r.sim, r.n) for r in neighbours.similarities(
            ratings, asked, "user_id", "item_id", kind).collect()}
        some = {(r.a, r.b): (r.sim, r.n) for r in neighbours.similarities(
            ratings, asked, "user_id", "item_id", kind, wanted=wanted).collect()}
        assert some == {p: every[p] for p in [(0, 7), (0, 8), (5, 0)]}
