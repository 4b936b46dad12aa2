"""The registered queries: each applies its operator to its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from tidemark.llm import chat
from tidemark.llm.bpe import decode_documents, encode_documents
from tidemark.llm.checks import CHECKS
from tidemark.llm.common import fold, table
from tidemark.llm.html_content import extract_pages
from tidemark.llm.langid import predict_languages, train_language_model
from tidemark.llm.lexical import rank_documents
from tidemark.llm.mixing import mix_report
from tidemark.llm.mtree import top_products
from tidemark.llm.quality import quality_report
from tidemark.llm.rank_bpe import decode_by_ranks, encode_by_ranks
from tidemark.llm.simhash import near_duplicates
from tidemark.llm.suffix_tree import score_texts
from tidemark.llm.token_files import read_files, write_files
from tidemark.llm.whitening import whiten

WORD_PIECES = "word_bpe_49k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"
MERGES = "byte_bpe_50k.json"


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return quality_report(table(spark, folder, "documents")).select("doc_id", *counts, "base_failed", "kept")


CHAT_DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def chat_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest columns read back from formatted conversations."""
    sha = lambda text: hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
    for batch in batches:
        out = []
        for own, formatted, spans in zip(*(c.to_pylist() for c in batch.columns)):
            turns, loss = chat.read_turns(formatted), chat.read_loss(formatted, spans)
            digest = sha("".join(f"{role}\n{text}\n" for role, text in turns))
            out.append((own, len(turns), digest, len(loss), sha(loss), len(formatted)))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        columns = [pa.array([row[k] for row in out], kind) for k, kind in enumerate(kinds)]
        names = [part.split()[0] for part in CHAT_DIGEST.split(", ")]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def op2_chat(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.format_conversations(turns).mapInArrow(chat_digest, CHAT_DIGEST)


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    report = mix_report(table(spark, folder, "documents"))
    return report.select("doc_id", "size", "source_size", "target", "taken")


def op4_suffix_tree(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(table(spark, folder, "documents"), fold("doc_id", 5) != 1)


def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = train_language_model(documents.filter(fold("doc_id", 4) != 2))
    found = predict_languages(documents, model)
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    encoded = encode_documents(table(spark, folder, "documents"), path, pattern)
    return decode_documents(encoded, path).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


def op8_top_products(spark: SparkSession, folder: str) -> DataFrame:
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double"))
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    found = top_products(
        table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, vector=F.when(usable, whole)
    )
    return found.select("query_id", "rank", "vec_id", F.col("score").cast("long").alias("score"))


def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return read_files(write_files(table(spark, folder, "documents"), public_tokenizers.path(WORD_PIECES)))


def op10_html(spark: SparkSession, folder: str) -> DataFrame:
    return extract_pages(table(spark, folder, "pages"))


def op11_rank_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(MERGES)
    decoded = decode_by_ranks(encode_by_ranks(table(spark, folder, "documents"), path), path)
    digests = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("ids", "decoded")]
    return decoded.select("doc_id", "n_tokens", *digests)


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))


def op13_lexical(spark: SparkSession, folder: str) -> DataFrame:
    return rank_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


OPERATORS = (
    op1_quality, op2_chat, op3_mixing, op4_suffix_tree, op5_language, op6_bpe, op7_simhash, op8_top_products,
    op9_token_files, op10_html, op11_rank_bpe, op12_whitening, op13_lexical,
)
QUERIES = {f.__name__: f for f in OPERATORS}


def all_checks() -> dict[str, str]:
    return CHECKS
