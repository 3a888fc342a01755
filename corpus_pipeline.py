"""A corpus pipeline of the training-data operators.

language ID, exact dedup, near dedup, source mixing, byte-level BPE: each stage
takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as
Parquet and read again as the next stage's documents. All stages but the last
return the columns of the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sparkfit.llm import byte_bpe, exact_dedup, lang_id, mixture, near_dedup
from sparkfit.llm.common import documents
from sparkfit.session import drop_table, write_table

LANGUAGE_SCORE = 0.2
LANGUAGE_MARGIN = 0.3
LANGUAGE_LETTERS = 200
NEAR_SHINGLE = 5
NEAR_PERCENT = 80

# SQL cannot express language profiles, hashed draws or BPE merges; the stages
# and the whole are tested against brute-force versions.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in the language it is labelled with, or that has no
    label and is in a learned one. Those without text or letters go; of texts
    with ``LANGUAGE_LETTERS`` letters or more also those that score below
    ``LANGUAGE_SCORE`` and those that another language fits better than the
    label, by more than ``LANGUAGE_MARGIN``. The profiles are learned from the
    documents' own texts and labels."""
    return lang_id.keep_known_languages(docs, lang_id.fit_profiles(docs), least_score=LANGUAGE_SCORE,
                                        margin=LANGUAGE_MARGIN, least_letters=LANGUAGE_LETTERS)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the largest id, of each group of equal texts."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates."""
    return near_dedup.drop_near_duplicates(docs, shingle=NEAR_SHINGLE, percent=NEAR_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources draws them, in shuffled shards."""
    return mixture.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids, ids_sha256, decoded_sha256) of every document drawn."""
    return byte_bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                                     public_tokenizers.PATTERN, keep=["source"])


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each stage's result written first."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        result = write_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_table(docs)
        docs = result
    return docs
