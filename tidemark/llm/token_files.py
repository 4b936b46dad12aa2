"""Token ids as binary files with Elias-Fano encoded document boundaries.

Documents are encoded word by word (the tokenizer's rules never look across white space, so a word's
ids are remembered and reused), dealt to shards by ranges of ids, sorted inside shards and streamed to
one file a shard in the shared folder. A file holds the concatenated ids, the document ids, and the
boundaries between documents as an Elias-Fano sequence with sampled selects: about two bits a document
plus the low bits, instead of a 64-bit table. A file appears under its name only when complete, and an
attempt that is repeated writes the same bytes, so a lost executor leaves nothing half done.

Defined results: a null or empty text is the end id alone; documents with equal ids follow each other
in the order of their encoded ids; a null id comes first; no documents give no files and no rows; extra
columns are not read. Ids are integers. The shared folder must be one that Arrow's file systems open.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.chat import runs
from tidemark.llm.common import LOWER, Words, bound_batches, codes_of, packed, shuffle_parts, store, text_slices, tidy
from tidemark.session import shared_dir

MAGIC = b"TIDEIDS1"
FOOTER = "<QQQQQQB7x8s"  # ids, documents, ids' bytes, id list's bytes, low's, high's, id width, magic
SAMPLE = 512
WORD_CACHE = 400_000  # words whose ids a worker remembers, in each of two generations
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[list(b"0123456789abcdefghijklmnopqrstuvwxyz")] = True
IS_TAIL = np.zeros(256, dtype=bool)
IS_TAIL[list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")] = True

# Lower-case letters (a-z, ß to ÿ): a word of them alone is one piece of text to the rules below.
LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
LETTER_RULES = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
)
TOGETHER = 200  # such words are encoded as one text of so many


class EliasFano:
    """A non-decreasing sequence of ``count`` values below ``universe + 1``."""

    def __init__(self, count: int, universe: int, low: np.ndarray, high: np.ndarray):
        self.count, self.bits = count, self.low_bits(count, universe)
        self.low, self.high = low, high
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)])
        # sampled select: the byte that holds every SAMPLE-th set bit, and the set bits before that byte
        self.byte = np.searchsorted(ones, np.arange(0, count, SAMPLE), "right") - 1
        self.before = ones[self.byte]

    @staticmethod
    def low_bits(count: int, universe: int) -> int:
        return max(0, (universe // max(1, count)).bit_length() - 1)

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> tuple[np.ndarray, np.ndarray]:
        """(low, high) bytes of ascending values."""
        bits = cls.low_bits(len(values), universe)
        low = np.packbits(((values[:, None] >> np.arange(bits)) & 1).astype(np.uint8).ravel(), bitorder="little")
        high = np.zeros(len(values) + (universe >> bits) + 1, dtype=np.uint8)
        high[(values >> bits) + np.arange(len(values))] = 1
        return low, np.packbits(high, bitorder="little")

    def select(self, first: int, last: int) -> np.ndarray:
        """Values first .. last - 1."""
        if first >= last:
            return np.zeros(0, dtype=np.int64)
        a = self.byte[first // SAMPLE]
        skipped = self.before[first // SAMPLE]
        after = (last - 1) // SAMPLE + 1
        b = self.byte[after] + 1 if after < len(self.byte) else len(self.high)
        places = np.flatnonzero(np.unpackbits(self.high[a:b], bitorder="little")) + 8 * a
        upper = places[first - skipped : last - skipped] - np.arange(first, last)
        start, stop = first * self.bits, last * self.bits
        own = np.unpackbits(self.low[start // 8 : (stop + 7) // 8], bitorder="little")[start % 8 :]
        own = own[: stop - start].reshape(last - first, self.bits).astype(np.int64)
        return (upper << self.bits) | (own << np.arange(self.bits)).sum(axis=1, dtype=np.int64)


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True
    return made


@lru_cache(maxsize=2)
def final_ids(path: str) -> np.ndarray | None:
    """Which ids end a piece of text, if words of ``LETTERS`` are single pieces to this tokenizer, else nothing."""
    made = tokenizer(path)
    rules = json.loads(made.to_str())
    added = any(LETTERS.fullmatch(t["content"].encode()) for t in rules["added_tokens"])
    suffix = rules["model"].get("end_of_word_suffix")
    if (rules["normalizer"], rules["pre_tokenizer"]) != LETTER_RULES or added or made.truncation or made.padding or not suffix:
        return None
    found = np.zeros(made.get_vocab_size(), dtype=bool)
    found[[k for token, k in rules["model"]["vocab"].items() if token.endswith(suffix)]] = True
    return found


class WordEncoder:
    """Ids of slices of text, one distinct word at a time.

    Words are lower-cased (A-Z) as the tokenizer would, and cut before a final run of ASCII punctuation
    that follows a letter or digit, where its rules cut too; fewer distinct words remain to be encoded.
    New words of letters alone are encoded many at a time, as one text, which is cut after the ids that end a piece.
    Ids are remembered in two generations: when the younger is full it becomes the older, and what is
    used again returns to the younger.
    """

    def __init__(self, path: str, end_id: int):
        self.model, self.end_id = tokenizer(path), end_id
        self.kind = np.dtype("<u2" if self.model.get_vocab_size() <= 1 << 16 else "<u4")
        self.final = final_ids(path)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _cut(self, low: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(length of every piece of a word, number of pieces before each row)."""
        solid = np.maximum.accumulate(np.where(IS_TAIL[low], -1, np.arange(len(low))))
        last = solid[words.ends - 1]  # the last byte that is no punctuation
        cut = np.flatnonzero((last >= words.starts) & (last < words.ends - 1))
        before = low[last[cut]]
        latin = (low[np.maximum(last[cut] - 1, 0)] == 0xC3) & ((before & 0xC0) == 0x80) & ((before & 0x1F) != 0x17)
        cut = cut[IS_WORD[before] | latin]
        lengths = np.insert(words.ends - words.starts, cut + 1, words.ends[cut] - last[cut] - 1)
        lengths[cut + np.arange(len(cut))] = last[cut] + 1 - words.starts[cut]
        return lengths, words.first + np.searchsorted(cut, words.first)

    def _encoded(self, words: list[bytes], texts: list[str]) -> dict[bytes, bytes]:
        """The ids of each word; ``texts`` hold one word each, or are cut after the ids that end a piece."""
        found = [x.ids for x in self.model.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(found), self.kind)
        if len(texts) == len(words):
            ends = list(accumulate(map(len, found)))
        else:
            ends = (np.flatnonzero(self.final[ids]) + 1).tolist()
            if len(ends) != len(words):  # letters that the vocabulary lacks
                return self._encoded(words, [w.decode() for w in words])
        raw, size = ids.tobytes(), self.kind.itemsize
        return dict(zip(words, (raw[x * size : y * size] for x, y in pairwise([0, *ends]))))

    def _ids(self, kinds: list[bytes]) -> list[bytes]:
        if len(self.young) > WORD_CACHE:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        new = []
        for w in kinds:
            if w not in young:
                if w in old:
                    young[w] = old[w]
                else:
                    new.append(w)
        for a in range(0, len(new), 10_000):
            part = new[a : a + 10_000]
            whole = [w for w in part if LETTERS.fullmatch(w)] if self.final is not None else []
            if len(whole) > 1:
                texts = [b" ".join(whole[k : k + TOGETHER]).decode() for k in range(0, len(whole), TOGETHER)]
                young.update(self._encoded(whole, texts))
                part = [w for w in part if w not in young]
            young.update(self._encoded(part, [w.decode() for w in part]))
        return [young[w] for w in kinds]

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, limits of the rows)."""
        low = LOWER[data]
        words = Words(low, offsets)
        lengths, first = self._cut(low, words) if len(low) else (words.counts[:0], words.first)
        codes, kinds = codes_of(packed(low[words.inside], lengths))
        own = self._ids(kinds.to_pylist())
        sizes = np.fromiter(map(len, own), np.int64, len(own)) // self.kind.itemsize
        table = np.frombuffer(b"".join(own), self.kind)
        at = np.cumsum(sizes) - sizes
        each = sizes[codes]
        sums = np.concatenate([[0], np.cumsum(each)])
        limits = sums[first] + np.arange(len(offsets))  # an end id after each row
        rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
        out = np.full(limits[-1], self.end_id, dtype=self.kind)
        out[runs(sums[:-1] + rows, each)] = table[runs(at[codes], each)]
        return out, limits


@lru_cache(maxsize=2)
def word_encoder(path: str, end_id: int) -> WordEncoder:
    """The encoder of this worker: words remembered in one task serve the next."""
    return WordEncoder(path, end_id)


def encoded_ids(df: DataFrame, path: str, id_col: str, text_col: str, end_id: int, shards: int) -> DataFrame:
    """(shard, id, ids): ids of each text with the end id, and the shard by ranges of the id."""
    bound_batches(df.sparkSession)
    cuts = [k / shards for k in range(1, shards)] or [0.5]
    bounds = df.agg(F.percentile_approx(F.col(id_col).cast("long"), cuts, 10_000)).first()[0] or []
    edges = np.unique(np.array(bounds, dtype=np.int64)) if shards > 1 else np.zeros(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path, end_id)
        for batch in tidy(batches):
            for a, b, data, offsets in text_slices(batch.column(1)):
                ids, limits = encoder(data, offsets)
                raw, size = ids.tobytes(), encoder.kind.itemsize
                own = batch.column(0)[a:b]
                shard = np.searchsorted(edges, own.fill_null(np.iinfo(np.int64).min).to_numpy(), "left")
                ends = (limits * size).tolist()
                pieces = pa.array([raw[x:y] for x, y in zip(ends, ends[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), own, pieces], names=["shard", "id", "ids"])

    return df.select(F.col(id_col).cast("long").alias("id"), text_col).mapInArrow(run, "shard int, id long, ids binary")


def write_files(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, shards: int | None = None) -> DataFrame:
    """Write the ids of all documents; returns the stored manifest (shard, file, n_docs, n_ids)."""
    spark = df.sparkSession
    shards = shards or shuffle_parts(spark)
    folder = f"{shared_dir(spark)}/tidemark/token-ids-{uuid.uuid4().hex}"
    dealt = encoded_ids(df, path, id_col, text_col, end_id, shards)
    dealt = dealt.repartitionById(shards, "shard").sortWithinPartitions("id", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = word_encoder(path, end_id).kind
        store_fs, place = arrow_fs.FileSystem.from_uri(folder)
        out = target = part = None
        own, known, sizes, shard = [], [], [], -1
        for batch in tidy(batches):
            if not batch.num_rows:
                continue
            if out is None:
                shard = batch.column(0)[0].as_py()
                target = f"{place}/ids-{shard:06d}.bin"
                part = f"{target}.{uuid.uuid4().hex}"
                store_fs.create_dir(place, recursive=True)
                out = store_fs.open_output_stream(part)
            pieces = batch.column(2).to_pylist()
            out.write(b"".join(pieces))
            sizes.append(np.fromiter(map(len, pieces), np.int64, len(pieces)) // kind.itemsize)
            own.append(batch.column(1).fill_null(0).to_numpy())
            known.append(batch.column(1).is_valid().to_numpy(zero_copy_only=False))
        if out is None:
            return
        count = np.concatenate(sizes)
        limits = np.concatenate([[0], np.cumsum(count)])
        low, high = EliasFano.encode(limits, int(limits[-1]))
        listed = np.concatenate(own).astype("<i8").tobytes() + np.packbits(np.concatenate(known)).tobytes()
        for piece in (listed, low.tobytes(), high.tobytes()):
            out.write(piece)
        parts = (int(limits[-1]), len(count), int(limits[-1]) * kind.itemsize, len(listed), len(low), len(high), kind.itemsize)
        out.write(struct.pack(FOOTER, *parts, MAGIC))
        out.close()
        if store_fs.get_file_info(target).type != arrow_fs.FileType.NotFound:
            store_fs.delete_file(target)
        store_fs.move(part, target)
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([f"{folder}/ids-{shard:06d}.bin"]), pa.array([len(count)], pa.int64()), pa.array([int(limits[-1])], pa.int64())],
            names=["shard", "file", "n_docs", "n_ids"],
        )

    return store(dealt.mapInArrow(run, "shard int, file string, n_docs long, n_ids long"), "token-manifest")


class TokenFile:
    """An open file: document ids, boundaries, and ids of a range of documents."""

    def __init__(self, file: str):
        store_fs, place = arrow_fs.FileSystem.from_uri(file)
        self.source = store_fs.open_input_file(place)
        end = self.source.size() - struct.calcsize(FOOTER)
        self.n_ids, self.n_docs, ids, listed, low, high, width, magic = struct.unpack(FOOTER, self._read(end, struct.calcsize(FOOTER)))
        if magic != MAGIC:
            raise ValueError(f"not a token file: {file}")
        self.kind = np.dtype("<u2" if width == 2 else "<u4")
        rest = np.frombuffer(self._read(ids, listed + low + high), np.uint8)
        self.doc_ids = rest[: 8 * self.n_docs].view("<i8")
        self.known = np.unpackbits(rest[8 * self.n_docs : listed], count=self.n_docs).astype(bool)
        self.limits = EliasFano(self.n_docs + 1, self.n_ids, rest[listed : listed + low], rest[listed + low :])

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def ids(self, first: int, last: int) -> np.ndarray:
        size = self.kind.itemsize
        return np.frombuffer(self._read(first * size, (last - first) * size), self.kind)


def read_files(manifest: DataFrame, step: int = 2000) -> DataFrame:
    """Per document: doc_id, start (ids before it in all files), n_tokens, ids_crc32."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"), "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tidy(batches):
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = TokenFile(name)
                for a in range(0, own.n_docs, step):
                    b = min(own.n_docs, a + step)
                    limits = own.limits.select(a, b + 1)
                    ids = own.ids(limits[0], limits[-1]).astype("<u4").tobytes()
                    cut = ((limits - limits[0]) * 4).tolist()
                    crc = [zlib.crc32(ids[x:y]) for x, y in zip(cut, cut[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own.doc_ids[a:b], pa.int64(), mask=~own.known[a:b]), pa.array(base + limits[:-1]), pa.array(np.diff(limits)), pa.array(crc, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    shards = shuffle_parts(manifest.sparkSession)
    return placed.repartitionById(shards, F.col("shard") % shards).select("file", "base").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
