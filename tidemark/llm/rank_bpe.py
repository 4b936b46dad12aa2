"""Byte-level BPE by a merge table, with a contiguous array of part boundaries and adjacent ranks per word.

A text is cut into words by the pattern below (strings of special tokens are set apart first). A short
word holds its part boundaries, part ids and the ranks of adjacent parts in contiguous rows: the smallest
rank is found by a scan, its boundary deleted, and the ranks of the two neighbours are looked up anew, until
no adjacent parts merge. Words of equal length take these steps together, a row each; every step takes one
part from every row, so the rows stay equally wide. Words above ``SHORT_BYTES`` keep the same ranks in a heap
over linked parts, which does not scan. Ids of words are remembered by a worker, up to ``WORD_CACHE`` words.

Defined results: a null or empty text has no ids and decodes to the empty text; ids may be null or repeated,
rows are encoded independently; no rows give no rows; extra columns are not read. Texts of any length are
encoded whole, words of a long text some at a time. The string of a special token in a text becomes its id, as
in the library, or ordinary text with ``special_in_text=False``. Decoding leaves out ids that the file does not
name and puts U+FFFD for bytes that are no UTF-8. A tokenizer file with other steps than these is refused.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bpe import decode_ids
from tidemark.llm.common import bound_batches, mixed, tidy

# Fixed value: the word pattern of byte-level tokenizers.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SHORT_BYTES = 48
WORD_CACHE = 400_000
WORDS_AT_ONCE = 100_000  # of a long text
LONG_TEXT = 1 << 20
ROWS_AT_ONCE = 8192
NONE = np.int32(2**31 - 1)  # the rank of parts that do not merge


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte: itself where it is visible Latin-1, else one from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or (161 <= b <= 255 and b != 173)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class RankTable:
    """Ids of bytes, ranks and results of merges, bytes of ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        model, letters = said["model"], byte_letters()
        split, plain = said["pre_tokenizer"] or {}, ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        known = model["type"] == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex", True)
        odd = said["normalizer"] or said["post_processor"] or split.get("add_prefix_space") or any(model.get(k) for k in plain)
        if not known or odd or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in said["added_tokens"]):
            raise ValueError(f"not a plain byte-level BPE file: {path}")
        vocab = model["vocab"]
        self.first = np.array([vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])], dtype=np.int32)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs] + [0], dtype=np.int32)
        self.ranks = {(a << 32) | b: k for k, (a, b) in enumerate(zip(left.tolist(), right.tolist()))}
        self._index((left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64))
        self.special = {t["content"]: t["id"] for t in said["added_tokens"]}
        names = {i: bytes(letters[c] for c in t) for t, i in vocab.items()}
        names |= {i: t.encode() for t, i in self.special.items()}
        own = [names.get(k, b"") for k in range(max(names) + 1)]
        self.at = np.zeros(len(own) + 1, dtype=np.int64)
        np.cumsum([len(t) for t in own], out=self.at[1:])
        self.bytes = np.frombuffer(b"".join(own), np.uint8)

    def _index(self, keys: np.ndarray) -> None:
        """An open hash table of the pairs, at most a quarter full."""
        self.mask = np.uint64((1 << (4 * max(1, len(keys))).bit_length()) - 1)
        self.slots = np.full(int(self.mask) + 1, 2**64 - 1, dtype=np.uint64)
        self.slot_rank = np.full(len(self.slots), NONE, dtype=np.int32)
        place, rest, self.reach = mixed(keys) & self.mask, np.arange(len(keys)), 0
        while len(rest):
            free = rest[self.slots[place[rest]] == 2**64 - 1]
            self.slots[place[free]] = keys[free]  # of several keys for one slot the last stays
            held = self.slots[place[rest]] == keys[rest]
            self.slot_rank[place[rest[held]]] = rest[held]
            rest = rest[~held]
            place[rest] = (place[rest] + np.uint64(1)) & self.mask
            self.reach += 1

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of adjacent parts, ``NONE`` where they do not merge."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        place = mixed(keys) & self.mask
        out = np.where(self.slots[place] == keys, self.slot_rank[place], NONE)
        open_ = np.flatnonzero((self.slots[place] != keys) & (self.slots[place] != 2**64 - 1))
        for _ in range(self.reach):
            if not len(open_):
                break
            place[open_] = (place[open_] + np.uint64(1)) & self.mask
            here = self.slots[place[open_]]
            hit = here == keys[open_]
            out[open_[hit]] = self.slot_rank[place[open_[hit]]]
            open_ = open_[~hit & (here != 2**64 - 1)]
        return out


@lru_cache(maxsize=2)
def rank_table(path: str) -> RankTable:
    return RankTable(path)


def without(array: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The rows without their element number ``at``."""
    keep = np.ones(array.shape, dtype=bool)
    keep[np.arange(len(array)), at] = False
    return array[keep].reshape(len(array), array.shape[1] - 1)


def merge_rows(ranks: RankTable, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, part ids, part boundaries) of words of one length, a word a row, as they are finished."""
    rows, width = np.arange(len(data)), data.shape[1]
    ids = ranks.first[data]
    bounds = np.tile(np.arange(width + 1, dtype=np.int32), (len(data), 1))
    near = ranks.rank_of(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(data), width - 1)
    while ids.shape[1] > 1:
        best = near.argmin(axis=1)
        low = near[np.arange(len(near)), best]
        done = low == NONE
        if done.any():
            yield rows[done], ids[done], bounds[done]
            open_ = ~done
            rows, ids, bounds, near, best, low = (x[open_] for x in (rows, ids, bounds, near, best, low))
        if not len(rows):
            return
        each = np.arange(len(rows))
        ids[each, best] = ranks.made[low]
        ids, bounds, near = without(ids, best + 1), without(bounds, best + 1), without(near, best)
        if ids.shape[1] == 1:
            break
        has = best > 0
        near[each[has], best[has] - 1] = ranks.rank_of(ids[each[has], best[has] - 1], ids[each[has], best[has]])
        has = best < ids.shape[1] - 1
        near[each[has], best[has]] = ranks.rank_of(ids[each[has], best[has]], ids[each[has], best[has] + 1])
    if len(rows):
        yield rows, ids, bounds


def merge_long(ranks: RankTable, word: bytes) -> list[int]:
    """The ids of one long word: parts linked both ways, a heap of (rank, place)."""
    ids = ranks.first[np.frombuffer(word, np.uint8)].tolist()
    after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
    alive = bytearray(b"\1") * len(ids)

    def rank(at: int) -> int | None:
        return ranks.ranks.get((ids[at] << 32) | ids[after[at]]) if at >= 0 and after[at] < len(ids) else None

    heap = [(r << 40) | k for k in range(len(ids)) if (r := rank(k)) is not None]
    heapq.heapify(heap)
    while heap:
        top = heapq.heappop(heap)
        at, wanted = top & ((1 << 40) - 1), top >> 40
        if not alive[at] or rank(at) != wanted:
            continue
        gone = after[at]
        ids[at], alive[gone], after[at] = int(ranks.made[wanted]), 0, after[gone]
        if after[at] < len(ids):
            before[after[at]] = at
        for k in (before[at], at):
            if (r := rank(k)) is not None:
                heapq.heappush(heap, (r << 40) | k)
    return [i for i, on in zip(ids, alive) if on]


class RankEncoder:
    """Encodes texts; the ids of words met before are remembered."""

    def __init__(self, path: str, special_in_text: bool = True):
        self.table = rank_table(path)
        self.cut = regex.compile(WORD_PATTERN)
        known = sorted(self.table.special, key=len, reverse=True) if special_in_text else []
        self.special = regex.compile("|".join(map(regex.escape, known))) if known else None
        self.seen: dict[str, bytes] = {}

    def learn(self, words: set[str]) -> None:
        """Encode the words not seen yet, those of one length together."""
        if len(self.seen) > WORD_CACHE:
            self.seen = {}
        new: dict[int, list[tuple[str, bytes]]] = {}
        for word in words:
            if word not in self.seen:
                raw = word.encode()
                new.setdefault(len(raw), []).append((word, raw))
        for size, group in new.items():
            if size > SHORT_BYTES:
                for word, raw in group:
                    self.seen[word] = np.array(merge_long(self.table, raw), dtype="<u4").tobytes()
                continue
            for a in range(0, len(group), ROWS_AT_ONCE):
                part = group[a : a + ROWS_AT_ONCE]
                data = np.frombuffer(b"".join(raw for _, raw in part), np.uint8).reshape(len(part), size)
                for rows, ids, _ in merge_rows(self.table, data):
                    raw, step = ids.astype("<u4").tobytes(), 4 * ids.shape[1]
                    self.seen.update((part[r][0], raw[k * step : (k + 1) * step]) for k, r in enumerate(rows.tolist()))

    def sections(self, text: str) -> Iterator[tuple[str, bytes]]:
        """(text before a special token, the token's id) until the end."""
        at = 0
        if self.special:
            for found in self.special.finditer(text):
                yield text[at : found.start()], np.array([self.table.special[found[0]]], dtype="<u4").tobytes()
                at = found.end()
        yield text[at:], b""

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        short = [(k, t) for k, t in enumerate(texts) if t and len(t) <= LONG_TEXT]
        out = [b""] * len(texts)
        cut = [(k, [(self.cut.findall(part), token) for part, token in self.sections(t)]) for k, t in short]
        self.learn(set(chain.from_iterable(words for _, parts in cut for words, _ in parts)))
        own = self.seen.__getitem__
        for k, parts in cut:
            out[k] = b"".join(b"".join(map(own, words)) + token for words, token in parts)
        for k, t in enumerate(texts):
            if t and len(t) > LONG_TEXT:
                out[k] = b"".join(self._long(t))
        return out

    def _long(self, text: str) -> Iterator[bytes]:
        for part, token in self.sections(text):
            found = (m[0] for m in self.cut.finditer(part))
            while words := list(islice(found, WORDS_AT_ONCE)):
                self.learn(set(words))
                yield b"".join(map(self.seen.__getitem__, words))
            yield token


def text_groups(column: pa.Array, budget: int = LONG_TEXT) -> Iterator[tuple[int, int, list[str | None]]]:
    """(first row, last row, texts) of some rows at a time, a text beyond the budget by itself."""
    texts, first, size = [], 0, 0
    for k, value in enumerate(column):
        text = value.as_py()
        texts.append(text)
        size += len(text or "")
        if size > budget:
            yield first, k + 1, texts
            texts, first, size = [], k + 1, 0
    if texts:
        yield first, len(column), texts


def encode_by_ranks(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", special_in_text: bool = True) -> DataFrame:
    """Per row: id, ``ids`` (little-endian unsigned 32-bit) and ``n_tokens``."""
    bound_batches(df.sparkSession)
    fields = [T.StructField(id_col, df.schema[id_col].dataType), T.StructField("ids", T.BinaryType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = RankEncoder(path, special_in_text)
        for batch in tidy(batches):
            for a, b, texts in text_groups(batch.column(1)):
                ids = pa.array(encoder(texts), pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], ids], names=[id_col, "ids"])

    coded = df.select(id_col, text_col).mapInArrow(run, T.StructType(fields))
    return coded.withColumn("n_tokens", F.expr("CAST(octet_length(ids) / 4 AS BIGINT)"))


def decode_text(table: RankTable, ids: bytes | None) -> str:
    own = np.frombuffer(ids or b"", "<u4")
    own = own[own < len(table.at) - 1]
    return decode_ids(own.tobytes(), table.bytes, table.at).decode("utf-8", "replace")


def decode_by_ranks(df: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """The rows with one more column, ``decoded``: the text of their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rank_table(path)
        for batch in tidy(batches):
            ids = batch.column(batch.schema.get_field_index(ids_col))
            texts = pa.array([decode_text(table, x.as_py()) for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, "decoded"])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("decoded", T.StringType())]))
