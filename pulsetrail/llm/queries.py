"""The registered query of every operator: whole tables, production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.llm.centroids import cluster_vectors
from pulsetrail.llm.decontaminate import contamination
from pulsetrail.llm.exact_dedup import exact_duplicates
from pulsetrail.llm.fingerprint import compare_edited
from pulsetrail.llm.langid import identify
from pulsetrail.llm.lexical_search import rank_documents
from pulsetrail.llm.mixing import plan_mix
from pulsetrail.llm.orc_tokens import token_index, write_token_ids
from pulsetrail.llm.probminhash import near_duplicates
from pulsetrail.llm.quality import score_quality
from pulsetrail.llm.secret_scan import find_secrets
from pulsetrail.llm.sentencepiece_scan import digests, encode
from pulsetrail.llm.suffix_tree import score_texts
from pulsetrail.materialize import scratch_path

# Vocabulary files are read where they are installed.
TOKENIZERS = os.path.dirname(public_tokenizers.path("word_bpe_49k.json"))


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def fold(modulus: int) -> Column:
    """The fold of a document: the CRC-32 of its id as text."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def op1_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return find_secrets(_documents(spark, sf))


def op2_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_duplicates(_documents(spark, sf), digest_all=True)


def op3_mixing(spark: SparkSession, sf: str) -> DataFrame:
    plan = plan_mix(_documents(spark, sf))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op4_orc_tokens(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "orc")
    write_token_ids(_documents(spark, sf), path, f"{TOKENIZERS}/word_bpe_49k.json")
    return token_index(spark, path)


def op5_quality(spark: SparkSession, sf: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf}/labels.parquet").where(fold(3) != 1).select("doc_id", "quality")
    scored = score_quality(_documents(spark, sf), labels)
    return scored.select(
        "doc_id",
        F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op6_langid(spark: SparkSession, sf: str) -> DataFrame:
    found = identify(_documents(spark, sf), fold(4) == 2)
    return found.select("doc_id", "held_out", "lang_pred", "score", "entropy", "rejected")


def op7_probminhash(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(_documents(spark, sf)).drop("mark")


def op8_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return compare_edited(_documents(spark, sf))


def op9_suffix_tree(spark: SparkSession, sf: str) -> DataFrame:
    return score_texts(_documents(spark, sf), fold(7) == 2)


def op10_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    model = f"{TOKENIZERS}/piece_bpe_32k.model"
    return digests(encode(_documents(spark, sf), model), model)


def op11_centroids(spark: SparkSession, sf: str) -> DataFrame:
    found = cluster_vectors(spark.read.parquet(f"{sf}/embeddings.parquet"))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return found.withColumn("centroid_sha256", digest).drop("centroid")


def op12_winnowing(spark: SparkSession, sf: str) -> DataFrame:
    found = contamination(_documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op13_nra_search(spark: SparkSession, sf: str) -> DataFrame:
    return rank_documents(_documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_mixing": op3_mixing,
    "op4_orc_tokens": op4_orc_tokens,
    "op5_quality": op5_quality,
    "op6_langid": op6_langid,
    "op7_probminhash": op7_probminhash,
    "op8_fingerprints": op8_fingerprints,
    "op9_suffix_tree": op9_suffix_tree,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_centroids": op11_centroids,
    "op12_winnowing": op12_winnowing,
    "op13_nra_search": op13_nra_search,
}
