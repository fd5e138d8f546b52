"""Plans and edge cases of counts, quantiles, ranks, joins and CSV scans."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tastegrid.operators import aggregate, bins, encode, joins, metrics
from tastegrid.operators.ranking import exact_quantiles
from tastegrid.session import local_session, scratch_path
from tastegrid.sources import files


@pytest.fixture(scope="module")
def spark():
    return local_session(cores=4, shuffle_partitions=4, memory="3g")


def plan_of(frame):
    return frame._jdf.queryExecution().toString()


def test_quantiles_by_rank(spark):
    draw = random.Random(8)
    values = {"a": [draw.choice([-3.5, 0.0, 1.0, 1.0, 2.5, 1e9, 1e-9]) for _ in range(200)],
              "b": [draw.gauss(0, 1) for _ in range(301)], "c": [7.0], "d": [1.0, 2.0]}
    rows = [(g, v) for g, vs in values.items() for v in vs]
    freq = spark.createDataFrame(rows, "g string, value double").groupBy("g", "value").agg(F.count("*").alias("n"))
    shares = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    got = {r.g: r.quantiles for r in exact_quantiles(freq, shares, "g").collect()}
    for g, vs in values.items():
        assert np.allclose(got[g], np.quantile(vs, shares))
    assert exact_quantiles(freq.where("false").drop("g"), shares).first().quantiles == []
    assert "percentile" not in plan_of(bins.quantile_edges(freq.drop("g")))


def test_distinct_sizes(spark):
    frame = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a"), (2, None), (1, "a")], "u long, i string")
    assert aggregate.distinct_sizes(frame, "u", "i").first() == (5, 2, 2)
    assert aggregate.distinct_count(frame, "u", "i").first() == (2, 2)
    assert aggregate.density(frame, "u", "i").first().density == 5 / 4
    assert "Expand" not in plan_of(aggregate.distinct_count(frame, "u", "i"))
    assert aggregate.distinct_sizes(frame.limit(0), "u", "i").first() == (0, 0, 0)


def test_left_join_of_events(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (None, "n")], "k long, name string")
    events = spark.createDataFrame([(1, 5.0), (1, 6.0), (3, None), (9, 1.0), (None, 2.0)], "k long, v double")
    got = joins.left_join_events(left, events, "k").collect()
    want = left.join(events, "k", "left").collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


@pytest.mark.parametrize("scores", ["even", "one", "whole"])
def test_ranking_spreads_any_score(spark, scores):
    value = {"even": F.rand(1), "one": F.lit(0.5), "whole": F.floor(F.rand(2) * 3).cast("double")}[scores]
    frame = spark.range(5000).select(F.lit("g").alias("g"), F.col("id").alias("item"), value.alias("score")).cache()
    sizes = frame.groupBy(metrics.score_cuts(frame, "item", "score").alias("b")).count()
    assert sizes.agg(F.max("count")).first()[0] < 600
    got = {r.item: r.rank for r in metrics.ranking(frame, "g", "item", "score").collect()}
    order = sorted(frame.collect(), key=lambda r: (-r.score, r.item))
    assert got == {r.item: i for i, r in enumerate(order, 1)}


def test_months_without_rows(spark):
    frame = spark.sql("select date'2020-02-03' as d union all select date'2021-02-01' union all select null")
    assert [(r.month, r["count"]) for r in bins.month_histogram(frame, "d").collect()] == [
        (m, 2 if m == 2 else 0) for m in range(1, 13)]


def test_feature_lists_are_planned_once(spark):
    rows = [("i", "f", 1.0), ("i", "g", 0.0), ("j", "f", 2.0), ("j", "h", 1.0), ("k", "g", 0.0)]
    features = spark.createDataFrame(rows, "item string, feature string, value double")
    listed = encode.present_features(features, "item")
    assert sorted(map(tuple, listed.collect())) == [
        ("i", "f", 1 / 2), ("i", "id:i", 1 / 2), ("j", "f", 1 / 3), ("j", "h", 1 / 3), ("j", "id:j", 1 / 3), ("k", "id:k", 1.0)]
    assert "Join" not in plan_of(listed)


def test_csv_keeps_line_ends_and_counts_bad_records(spark):
    schema = StructType([StructField("id", LongType()), StructField("text", StringType()), StructField("v", DoubleType())])
    rows = [(1, "two\nlines", 1.5), (2, 'a "quoted", one', None), (3, "", 2.0)]
    path = scratch_path(spark, "csv")
    files.write_csv(spark.createDataFrame(rows, schema), path)
    back = files.read_csv(spark, path, schema, quoted_newlines=True).orderBy("id").collect()
    assert [tuple(r) for r in back][:2] == rows[:2] and back[2].id == 3
    assert files.unreadable_records(spark, path, schema, quoted_newlines=True) == 0
    spark.createDataFrame([("id,text,v",), ("x,a,1.0",), ("2,b",), ("3,c,1.0",)], "value string").coalesce(1).write.text(path + "-bad")
    assert files.unreadable_records(spark, path + "-bad", schema) == 2
    assert sorted(r.id for r in files.read_csv(spark, path + "-bad", schema).collect() if r.id) == [2, 3]
