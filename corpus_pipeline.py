"""The corpus pipeline: from raw documents to the token ids of a mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and
read again as the next one's ``docs``. Every stage works on all rows it is given; all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.llm.exact_dedup import drop_copies
from pulsetrail.llm.langid import drop_rejected
from pulsetrail.llm.mixing import mix
from pulsetrail.llm.probminhash import drop_near_duplicates
from pulsetrail.llm.queries import TOKENIZERS
from pulsetrail.llm.sentencepiece_scan import encode
from pulsetrail.materialize import materialize

MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no known language: without letters, or far off every model.

    The models are learned from all documents that have a language.
    """
    return drop_rejected(docs, F.lit(False))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of equal texts."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near-duplicates."""
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mix the sources to their target weights; documents taken twice are two rows."""
    return mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix: doc_id, n_tokens, ids."""
    return encode(docs, MODEL).select("doc_id", F.size("ids").alias("n_tokens"), "ids")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("sentencepiece", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs


# Language models, signatures and pieces are beyond SQL.
ORACLE_SQL = None
