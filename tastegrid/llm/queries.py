"""Registered queries of the operators in this folder, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tastegrid.llm import (alignment, byte_bpe, fingerprints, jaccard, packing, personal, quality, rules, sharding,
                           structure, substrings, suffixes, toxicity)
from tastegrid.llm.tables import conversations, documents, labels

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def registered(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_file(name: str) -> str:
    """Path of a vocabulary file installed beside Python."""
    import public_tokenizers

    return public_tokenizers.path(name)


@registered
def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(documents(spark, sf_dir))


@registered
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"))


@registered
def op3_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(documents(spark, sf_dir), labels(spark, sf_dir))


@registered
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encoded_digests(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"))


@registered
def op5_longest_first_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir))


@registered
def op6_lexicon_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(documents(spark, sf_dir), labels(spark, sf_dir))


@registered
def op7_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprinted(documents(spark, sf_dir))


@registered
def op8_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removed_windows(documents(spark, sf_dir)).drop("kept")


@registered
def op9_certified_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = rules.rule_verdicts(documents(spark, sf_dir), labels(spark, sf_dir))
    return verdicts.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                           "base_failed", "kept")


@registered
def op10_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removed_bytes(documents(spark, sf_dir)).drop("kept")


@registered
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned_documents(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"),
                                       tokenizer_file("piece_bpe_32k.model"))


@registered
def op12_personal_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.personal_spans(documents(spark, sf_dir))


@registered
def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.conversation_repairs(structure.damaged(conversations(spark, sf_dir)))
