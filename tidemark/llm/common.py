"""Helpers of the operators: Arrow text as flat bytes, words, stored intermediates, row splits."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import settle

# The white space between words, and the word pattern in Java and DuckDB syntax.
GAP_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
# Work arrays are built for this many bytes of text at a time; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20

IS_GAP = np.zeros(256, dtype=bool)
IS_GAP[list(GAP_BYTES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def bound_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches sent to Python hold at most ``rows`` rows and some 16 MB, so that long texts fit."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    return settle(df, name)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % parts


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow column as one byte array and row offsets; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, budget: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``budget`` bytes each; every row is in exactly one range."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + budget, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def text_slices(
    column: pa.Array, budget: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, offsets from 0) of each slice of the column."""
    data, offsets = flat(column)
    for a, b in slices(offsets, budget):
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task; a worker that is kept for later tasks then gives its free memory back."""
    yield from batches
    pa.default_memory_pool().release_unused()


class Words:
    """Word positions of a slice: starts, ends, row of each word, and words before each row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        inside = ~IS_GAP[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        before = np.empty(len(data), dtype=bool)
        after = np.empty(len(data), dtype=bool)
        if len(data):
            before[0], after[-1] = True, True
            np.logical_not(inside[:-1], out=before[1:])
            np.logical_not(inside[1:], out=after[:-1])
            before |= edge[:-1]
            after |= edge[1:]
        self.inside = inside
        self.starts = np.flatnonzero(inside & before)
        self.ends = np.flatnonzero(inside & after) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.row = np.repeat(np.arange(len(self.counts)), self.counts)

    def arrow(self, data: np.ndarray) -> pa.Array:
        """The words as an Arrow array (binary, 64-bit offsets)."""
        return packed(data[self.inside], self.ends - self.starts)


def packed(data: np.ndarray, lengths: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """Arrow array over contiguous bytes with the given value lengths."""
    at = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=at[1:])
    return pa.Array.from_buffers(
        kind or pa.large_binary(), len(lengths), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data))]
    )


def codes_of(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Exact integer codes of the values, and the distinct values."""
    encoded = values.dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalising mix (two xor-shift-multiply rounds)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def repeated(keys: np.ndarray, later_only: bool = False) -> np.ndarray:
    """Mask of keys found more than once (``later_only``: without each key's first place)."""
    return pd.Series(keys, copy=False).duplicated(keep="first" if later_only else False).to_numpy()


def hex_digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
