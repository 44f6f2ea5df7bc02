"""Registry of the document operators: one query per operator, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    fingerprints, language, merkle, mixing, near_dedup, negatives, packing, pii, quality, repeats, secrets, tokens, toxicity,
)
from .common import documents, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(documents(spark, sf_dir))
    further = ["n_lines", "n_upper"]
    return judged.select(*[n for n in judged.columns if n not in further], *further)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict(documents(spark, sf_dir))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(documents(spark, sf_dir))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(documents(spark, sf_dir))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.without_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(negatives.relabelled(table(spark, sf_dir, "embeddings")))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_check(documents(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_language": op2_language,
        "op3_token_counts": op3_token_counts,
        "op4_mixing": op4_mixing,
        "op5_near_dedup": op5_near_dedup,
        "op6_pii": op6_pii,
        "op7_fingerprints": op7_fingerprints,
        "op8_toxicity": op8_toxicity,
        "op9_secrets": op9_secrets,
        "op10_packing": op10_packing,
        "op11_repeats": op11_repeats,
        "op12_negatives": op12_negatives,
        "op13_merkle": op13_merkle,
    }
