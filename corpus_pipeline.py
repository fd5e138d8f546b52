"""Preparing a corpus for training: quality rules, classifier, near copies, repeats, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``docs``.  A stage judges its own input.  Labels come from
``labels`` in ``sf_dir`` and serve to calibrate and fit only.

Null texts are empty and go at the first stage, as do other texts under 20 words.
Of a group of near copies the row with the smallest doc_id stays; rows that share
a doc_id but not a text are documents of their own, and of rows that share both
one stays.  Rows without a doc_id take no part in that.  A document whose text is
all repeats stays with an empty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid.llm import jaccard, packing, quality, rules, suffixes
from tastegrid.llm.queries import tokenizer_file
from tastegrid.llm.tables import documents, labels, written

TOKENIZER = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base check and the certified rules."""
    return rules.kept_documents(docs, labels(spark, sf_dir))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores as good."""
    return quality.good_documents(docs, labels(spark, sf_dir))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles at similarity 0.8: the one with the smallest id."""
    rows = jaccard.jaccard_groups(docs, n=5, percent=80).where("doc_id is not null")
    # rows without words are linked with nothing, and each is a group of its own
    groups = F.coalesce(F.col("group_id").cast("string"), F.concat_ws(":", "doc_id", "text_key"))
    heads = (rows.groupBy(groups.alias("group")).agg(F.min(F.struct("doc_id", "text_key")).alias("head"))
             .select(F.col("head.doc_id").alias("_id"), F.col("head.text_key").alias("_key")))
    marked = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("_id"),
                         F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("_key"))
    kept = marked.join(heads, ["_id", "_key"], "left_semi").dropDuplicates(["_id", "_key"])
    return kept.unionByName(marked.where("_id is null")).select("row.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of 200-byte strings that occur twice."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    rows = docs.select("doc_id", "text", F.struct(*others).alias("_row"))
    cut = suffixes.removed_bytes(rows, also=("_row",))
    # a cut inside a character leaves bytes that are no text; they go as well
    kept = F.col("kept").cast("string")
    bare = F.replace(F.make_valid_utf8(kept), F.lit("\ufffd"), F.lit(""))
    out = cut.withColumn("text", F.when(F.is_valid_utf8(kept), kept).otherwise(bare))
    fields = {c: F.col(f"_row.{c}") for c in others} | {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in others:
        fields["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*(fields[c].alias(c) for c in docs.columns))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of at most 2048 ids."""
    return packing.pack_documents(docs, tokenizer_file(TOKENIZER))


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_copies),
    ("suffix-array dedup", repeated_passages),
    ("best-fit packing", packed_sequences),
]

#: The classifier and the tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
