"""Regression tests on literal tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tastegrid.operators import aggregate, bins, sample
from tastegrid.session import local_session


@pytest.fixture(scope="module")
def spark():
    return local_session(cores=4, shuffle_partitions=4, memory="3g")


def test_null_has_no_bin(spark):
    frame = spark.createDataFrame([(1.0,), (2.0,), (None,)], "x double")
    got = {r["x"]: r["bucket"] for r in bins.quantile_bins(frame, "x", 2).collect()}
    assert got[None] is None and got[1.0] == 1


def test_empty_bins_stay(spark):
    frame = spark.createDataFrame([(0.0,), (10.0,)], "x double")
    got = {r["bucket"]: r["count"] for r in bins.width_histogram(frame, "x", bins=5).collect()}
    assert got == {1: 1, 2: 0, 3: 0, 4: 0, 5: 1}


def test_split_keeps_null_keys(spark):
    frame = spark.createDataFrame([(str(i),) for i in range(50)] + [(None,)], "k string")
    train, test = sample.split(frame, F.col("k"), 0.3)
    assert train.count() + test.count() == 51


def test_null_has_a_place_in_keys(spark):
    frame = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    assert frame.select(sample.key_of("x", "y")).distinct().count() == 2


def test_share_of_zero_total(spark):
    frame = spark.createDataFrame([(0,), (0,)], "count long")
    assert [r["percent"] for r in aggregate.share_of_total(frame).collect()] == [None, None]
