"""A training-corpus pipeline over ``documents``: identify the language, apply quality rules, keep one
of each group of near copies, mix the sources, encode.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; ``run`` writes every
stage's result as Parquet in the shared folder and reads it back for the next. The stages before the
last return the columns of ``documents``; a document that the mix takes twice is two rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import decode_documents, encode_documents
from tidemark.llm.common import store, table
from tidemark.llm.langid import keep_identified, train_language_model
from tidemark.llm.mixing import mix_documents
from tidemark.llm.quality import keep_good
from tidemark.llm.simhash import keep_one_of_each

RANKS = "byte_bpe_multi_50k.tiktoken"


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs, train_language_model(docs))


def check_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    decoded = decode_documents(encode_documents(docs, path, pattern), path)
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "ids"
    )


STAGES = [
    ("language", identify),
    ("quality", check_quality),
    ("near_copies", drop_near_copies),
    ("mixing", mix),
    ("encoding", encode),
]

# Trained models, fingerprints and merges have no SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
