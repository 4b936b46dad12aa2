"""Byte-level BPE encoding and decoding by a rank file.

Short texts are encoded whole. Longer ones are cut into overlapping chunks that are pre-tokenised in
parallel tasks; neighbouring chunks are stitched at the first pre-token boundary that both find
between a non-space and a white-space character (such a boundary holds whatever stands before it, and
nothing left of it looks past it). Chunks whose overlap has no such boundary are joined and handled
as one piece. The pieces are then encoded and a document's ids are put together in order.

Defined results: a null or empty text has no ids and decodes to the empty bytes; repeated rows are
encoded independently; ids may be null or repeated; unknown columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bound_batches, store, tidy

CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 1 << 10


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The encoder of a rank file (``base64 rank`` per line), one per worker."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray]:
    """All tokens' bytes in one array, and their offsets by id."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    own = [ranks.get(k, b"") for k in range(max(ranks, default=-1) + 1)]
    at = np.zeros(len(own) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in own], out=at[1:])
    return np.frombuffer(b"".join(own), np.uint8), at


def encode_text(enc: tiktoken.Encoding, text: str | None) -> bytes:
    return np.array(enc.encode_ordinary(text), dtype="<u4").tobytes() if text else b""


def decode_ids(ids: bytes, tokens: np.ndarray, at: np.ndarray) -> bytes:
    """The raw bytes of the ids, one after the other."""
    own = np.frombuffer(ids, "<u4").astype(np.int64)
    sizes = at[own + 1] - at[own]
    end = np.cumsum(sizes)
    place = np.repeat(at[own] - (end - sizes), sizes) + np.arange(end[-1] if len(end) else 0)
    return tokens[place].tobytes()


def _encoded(path: str, pattern: str, keys: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path, pattern)
        for batch in tidy(batches):
            ids = [encode_text(enc, text.as_py()) for text in batch.column(keys)]
            kept = [batch.column(k) for k in range(keys)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(ids, pa.binary())], names=[*batch.schema.names[:keys], "ids"]
            )

    return run


def encode_documents(
    df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """Per document: id, ``ids`` (little-endian unsigned 32-bit) and ``n_tokens``."""
    if not 0 < overlap_chars < chunk_chars:
        raise ValueError("the overlap must be shorter than a chunk")
    bound_batches(df.sparkSession)
    id_field = T.StructField(id_col, df.schema[id_col].dataType)
    out = T.StructType([id_field, T.StructField("ids", T.BinaryType())])
    narrow = df.select(id_col, text_col)
    is_long = F.coalesce(F.length(text_col) > chunk_chars, F.lit(False))
    short = narrow.filter(~is_long).mapInArrow(_encoded(path, pattern, 1), out)
    pieces = long_pieces(narrow.filter(is_long), id_col, pattern, chunk_chars, overlap_chars)
    keyed = T.StructType([T.StructField("row", T.LongType()), id_field, T.StructField("piece", T.LongType()), out["ids"]])
    coded = pieces.mapInArrow(_encoded(path, pattern, 3), keyed)
    joined = F.sort_array(F.collect_list(F.struct("piece", "ids")))
    whole = coded.groupBy("row").agg(F.first(id_col).alias(id_col), joined.alias("parts")).select(
        id_col, F.aggregate("parts", F.lit(b""), lambda done, part: F.concat(done, part["ids"])).alias("ids")
    )
    return short.unionByName(whole).withColumn("n_tokens", F.expr("CAST(octet_length(ids) / 4 AS BIGINT)"))


def long_pieces(df: DataFrame, id_col: str, pattern: str, size: int, overlap: int) -> DataFrame:
    """Rows (row, id, piece, text): texts cut where overlapping chunks agree on a boundary."""
    id_field = T.StructField(id_col, df.schema[id_col].dataType)
    cut_fields = [
        T.StructField("row", T.LongType()), id_field, T.StructField("chunk", T.LongType()), T.StructField("text", T.StringType()),
    ]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tidy(batches):
            for row, own, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                for k, start in enumerate(range(0, len(text), size)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row], pa.int64()), pa.array([own], batch.column(1).type), pa.array([k], pa.int64()), pa.array([text[start : start + size + overlap]])],
                        names=["row", id_col, "chunk", "text"],
                    )

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = regex.compile(pattern)
        for batch in tidy(batches):
            heads, tails = [], []
            for text in batch.column(3).to_pylist():
                starts = [m.start() for m in matcher.finditer(text)]
                firm = [p for p in starts if p and text[p] in " \t\n\r" and not text[p - 1].isspace()]
                heads.append([p for p in firm if p < overlap])
                tails.append([p - size for p in firm if p >= size])
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(heads, kind), pa.array(tails, kind)],
                names=[*batch.schema.names, "head", "tail"],
            )

    places = T.ArrayType(T.LongType())
    marked_fields = [*cut_fields, T.StructField("head", places), T.StructField("tail", places)]
    numbered = df.select(F.monotonically_increasing_id().alias("row"), *df.columns)
    chunks = store(numbered.mapInArrow(cut, T.StructType(cut_fields)), "bpe-chunks")
    chunks = chunks.repartition("row", "chunk").mapInArrow(mark, T.StructType(marked_fields))
    chunks = store(chunks, "bpe-marks")
    left = chunks.select("row", (F.col("chunk") + 1).alias("chunk"), "tail")
    joint = F.array_min(F.array_intersect("tail", "head"))
    joints = chunks.select("row", "chunk", "head").join(left, ["row", "chunk"], "left").select(
        "row", "chunk", joint.alias("joint")
    )
    order = Window.partitionBy("row").orderBy("chunk")
    joints = joints.select(
        "row", "chunk", "joint",
        F.lead("joint").over(order).alias("next_joint"),
        F.lead("chunk").over(order).isNull().alias("is_last"),
        F.count("joint").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("piece"),
    )
    start = F.coalesce("joint", F.lit(0)) + 1
    stop = F.when(F.col("is_last"), F.length("text")).otherwise(size + F.coalesce("next_joint", F.lit(0)))
    parts = chunks.drop("head", "tail").join(joints, ["row", "chunk"]).select(
        "row", id_col, "piece", "chunk", F.substring("text", start, stop - start + 1).alias("text")
    )
    texts = F.sort_array(F.collect_list(F.struct("chunk", "text")))["text"]
    return parts.groupBy("row", "piece").agg(
        F.first(id_col).alias(id_col), F.array_join(texts, "").alias("text")
    ).select("row", id_col, "piece", "text")


def decode_documents(df: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """The rows with one more column, ``decoded``: the bytes of their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, at = token_bytes(path)
        for batch in tidy(batches):
            ids = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            decoded = pa.array([decode_ids(x or b"", tokens, at) for x in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], names=[*batch.schema.names, "decoded"])

    fields = [*df.schema.fields, T.StructField("decoded", T.BinaryType())]
    return df.mapInArrow(run, T.StructType(fields))
