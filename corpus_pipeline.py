"""Pipeline over the corpus: quality rules, near duplicates, personal data, mixing, packing.

Every stage works on all that the one before it kept; its input is a written table.  All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tradeloom.llm import mixing, near_dedup, packing, pii, quality
from tradeloom.llm.common import documents
from tradeloom.session import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents as often as they are taken."""
    return mixing.mixed_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("source mix", source_mix),
    ("packing", packed_sequences),
]

#: Exact similarity, a trained network and a tokenizer are beyond SQL; tests/llm holds brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result but the last is written and read again."""
    docs = documents(spark, sf_dir)
    *first, (_, last) = STAGES
    for _, stage in first:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return last(spark, docs, sf_dir)
