"""One query for each training-data operator, over the whole of its table.

The operators keep general interfaces; a query gives them production parameters
and derives its columns from what they return.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfit.llm import byte_bpe, chat, exact_dedup, fingerprints, lang_id, line_dedup, merkle, mixture
from sparkfit.llm import near_dedup, neighbours, token_counts, token_files, whitening
from sparkfit.llm.common import documents
from sparkfit.llm.vectors import finite_vectors
from sparkfit.session import scratch_path

END_ID = 2
TOKEN_LIMIT = 2048
NEAR_SHINGLE = 4
COMPONENTS = 16
NEIGHBOURS = 10


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    docs = documents(spark, sf_dir, "doc_id", "text")
    token_files.write_token_files(docs, path, public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return token_files.document_checksums(token_files.read_token_files(spark, path, dict(docs.dtypes)["doc_id"]))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    profiles = lang_id.fit_profiles(docs.where(~lang_id.is_held_out() & F.col("doc_id").isNotNull()))
    found = lang_id.predict_languages(docs, profiles)
    return found.select("doc_id", lang_id.is_held_out().alias("held_out"), "lang_pred", "score")


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixture.mix(documents(spark, sf_dir, "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", mixture.words_taken().alias("taken"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return near_dedup.near_duplicates(docs, shingle=NEAR_SHINGLE) \
        .select("doc_id", "n_shingles", "component_id", "kept")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(documents(spark, sf_dir, "doc_id", "text"), digest_all=True)
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir, "doc_id", "text"),
                                     public_tokenizers.path("word_bpe_49k.json"), TOKEN_LIMIT)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.kept_lines(documents(spark, sf_dir, "doc_id", "text"), digest=True)


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(documents(spark, sf_dir, "doc_id", "text"))


def op9_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chat.dialogues(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet"))
    ranges = F.transform("masks", lambda m: F.concat(m["start"].cast("string"), F.lit("-"), m["end"].cast("string")))
    return found.withColumn("masks", F.array_join(ranges, ","))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_digests(documents(spark, sf_dir, "doc_id", "text"),
                                   public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(embeddings(spark, sf_dir), "vec_id", "embedding", F.col("id") % 100 == 0, NEIGHBOURS)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = finite_vectors(embeddings(spark, sf_dir), "vec_id", "embedding")
    whole = F.transform("vec", lambda c: F.floor(64 * c) + 1000000)
    fits = ~F.exists("vec", lambda c: F.abs(c) >= 2.0 ** 45)
    return whitening.whiten(rows.where(fits).select("id", whole.alias("x")), "id", "x", COMPONENTS) \
        .withColumnRenamed("id", "vec_id")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = documents(spark, sf_dir, *fields)
    grown = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in fields]
    hit = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()
    rows = merkle.manifest(docs, fields, group="lang", key="doc_id",
                           carry={"tampered": F.when(hit, merkle.field_digest(grown))})
    shown = rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest().alias("proof_sha256"),
                        merkle.folded(F.coalesce("tampered", "leaf")).alias("folded_root"))
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_language_id": op2_language_id,
    "op3_source_mix": op3_source_mix,
    "op4_near_dedup": op4_near_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_line_dedup": op7_line_dedup,
    "op8_fingerprints": op8_fingerprints,
    "op9_chat_rotation": op9_chat_rotation,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_nearest_neighbours": op11_nearest_neighbours,
    "op12_whitening": op12_whitening,
    "op13_merkle_manifest": op13_merkle_manifest,
}
