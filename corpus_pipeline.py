"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

language      documents without a letter, or whose language is not recognized, go
near_copies   one document of each SimHash group stays, that of the smallest id
secrets       secrets are replaced by a sign; the other documents are unchanged
mixture       documents are taken as often as their source's target weight wants
pieces        every document that is left is encoded: sampled SentencePiece segmentations

Every stage takes the documents that its predecessor kept, decides on each of them, and keeps the columns of the table
(the last one gives the encoded rows). Null or repeated rows, empty tables and further columns are handled as the
operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from areafacts import scratch
from areafacts.llm import language_id, mixing, secrets, segmentation, simhash
from areafacts.llm.common import fold, importable
from areafacts.llm.queries import PIECES

# A document of one of several languages has more than this; noise is spread over all of them.
LEAST_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    model = language_id.learn(docs, fold("doc_id", 3) != 1)
    return language_id.accepted(docs, model, LEAST_SCORE)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return simhash.one_of_each(docs, shingle=3, max_distance=2)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return secrets.redact(docs, size_column="n_chars" if "n_chars" in docs.columns else None)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return mixing.mixture(docs, lambda names: [i % 3 + 1 for i in range(len(names))])


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return segmentation.encode(docs, PIECES, k=2, alpha=0.5)


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("secrets", without_secrets),
    ("mixture", mixture),
    ("pieces", pieces),
]

# Networks, fingerprints, compression and sampling have no SQL: tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.written(stage(spark, docs, sf_dir), name)[0]
    return docs
