"""Declared schemas of the file sources; nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T

GAMES = T.StructType([
    T.StructField("app_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("date_release", T.DateType()),
    T.StructField("win", T.BooleanType()),
    T.StructField("mac", T.BooleanType()),
    T.StructField("linux", T.BooleanType()),
    T.StructField("rating", T.StringType()),
    T.StructField("positive_ratio", T.IntegerType()),
    T.StructField("user_reviews", T.IntegerType()),
    T.StructField("price_final", T.DoubleType()),
    T.StructField("price_original", T.DoubleType()),
    T.StructField("discount", T.DoubleType()),
    T.StructField("handheld", T.BooleanType()),
])

RECOMMENDATIONS = T.StructType([
    T.StructField("app_id", T.LongType()),
    T.StructField("helpful", T.IntegerType()),
    T.StructField("funny", T.IntegerType()),
    T.StructField("date", T.DateType()),
    T.StructField("is_recommended", T.BooleanType()),
    T.StructField("hours", T.DoubleType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("review_id", T.LongType()),
])

GAMES_METADATA = T.StructType([
    T.StructField("app_id", T.LongType()),
    T.StructField("description", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
])
