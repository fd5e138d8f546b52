"""A random forest on documents and its importances (EV10, SRT7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastegrid.operators import forest, metrics, sample, stored
from tastegrid.plans.registry import registered
from tastegrid.sources import domain

NUMBERS = ("n_chars", "n_words", "n_lines", "word_chars", "capitals", "digits", "marks", "distinct_words")
LANGUAGES = {"lang": ("de", "en", "es", "fr")}


def labelled(spark, folder):
    """(train, test, names): measures of labelled documents, split 80/20."""
    docs = domain.table(spark, folder, "documents").select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    count = lambda pattern: F.regexp_count("text", F.lit(pattern))
    measured = docs.select(
        "doc_id", "lang", F.char_length("text").alias("n_chars"), F.size(words).alias("n_words"),
        count("\n").alias("n_lines"), F.try_divide(F.char_length("text"), F.size(words)).alias("word_chars"),
        count("[A-Z]").alias("capitals"), count("[0-9]").alias("digits"), count(r"[^\w\s]").alias("marks"),
        F.try_divide(F.size(F.array_distinct(words)), F.size(words)).alias("distinct_words"))
    labels = domain.table(spark, folder, "labels").select("doc_id", "quality")
    rows, names = forest.encoded(measured.join(labels, "doc_id"), "doc_id", "quality", NUMBERS, LANGUAGES)
    return (*sample.split(stored.written(rows, "labelled"), sample.key_of("doc_id"), 0.2), names)


# splits are drawn at random by Spark's forest, so these have no SQL twin
@registered("ev10_forest_predictions", None)
def forest_predictions(spark, folder):
    train, test, _ = labelled(spark, folder)
    return forest.predicted(forest.fit(train), test).select(
        "doc_id", F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"))


@registered("ev10_forest_report", None)
def forest_report(spark, folder):
    return metrics.classification_report(forest_predictions(spark, folder), "label", "prediction")


@registered("srt7_forest_importances", None)
def forest_importances(spark, folder):
    train, _, names = labelled(spark, folder)
    return forest.importances(forest.fit(train), names, spark)


@registered("srt7_permutation_importances", None)
def permutation_importances(spark, folder):
    train, test, names = labelled(spark, folder)
    return forest.permutation_importances(forest.fit(train), test, "doc_id", names)
