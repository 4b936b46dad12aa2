"""Ranked lexical search: an Aho-Corasick scan of all documents for the terms of all items.

No index of the documents is built. The distinct terms of the items make an automaton whose patterns carry
a boundary on both sides (terms are maximal runs, so a term inside a longer one does not count); it goes to
all tasks, which read each text once and count the terms' occurrences. Those counts are stored; from them come
the document frequencies, and in a last pass each task scores its documents against the items that its terms
lead to and keeps the best of each item, which are merged in two steps.

The items are the query set: they are read in blocks of some ``BLOCK_BYTES`` of text (dealt by a hash of the
item id), so that an automaton is never larger than that, and every block scans all documents.

Defined results: a null or empty text has no terms and is never found; an item without terms or without a
document of score above 0 has no rows; rows that share an item id are one item with all their terms; documents
that share an id are ranked one by one; a null id is an id of its own and, among equal scores, the smallest. No
documents or no items give no rows; extra columns are not read. Ids are integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, bound_batches, slices, store, text_slices, tidy

# Terms are maximal runs of these characters, A-Z lower-cased.
TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK_BYTES = 8 << 20
SCAN_BYTES = 1 << 18
LONG_BYTES = 1 << 22  # a longer text is scanned in pieces between terms
SCORE_CELLS = 1 << 21

IS_TERM = np.zeros(256, dtype=bool)
IS_TERM[128:] = True
IS_TERM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
GUARD = 0x20
FOLDED = np.where(IS_TERM, LOWER, GUARD).astype(np.uint8)


def terms_of(text) -> F.Column:
    """The distinct terms of a text, an empty array for null."""
    found = F.regexp_extract_all(F.translate(text, CAPITALS, SMALL), F.lit(f"({TERM_PATTERN})"))
    return F.coalesce(F.array_distinct(found), F.array().cast("array<string>"))


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[tuple[list, list[str], np.ndarray, np.ndarray]]:
    """Per block: item ids, sorted terms, and for each term the items that hold it (limits, item numbers)."""
    size = items.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    blocks = 1 + size // block_bytes
    own = items.select(F.col(id_col).alias("item"), F.col(text_col).alias("text"))
    for k in range(blocks):
        part = own.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k) if blocks > 1 else own
        pairs = part.select("item", F.explode(terms_of(F.col("text"))).alias("term")).distinct().toArrow()
        items_, terms = pairs["item"].to_pylist(), pairs["term"].to_pylist()
        ids = sorted(set(items_), key=lambda x: (x is not None, x or 0))
        names = sorted(set(terms))
        if not names:
            continue
        place, number = {t: n for n, t in enumerate(names)}, {i: n for n, i in enumerate(ids)}
        term = np.array([place[t] for t in terms])
        item = np.array([number[i] for i in items_])
        order = np.lexsort([item, term])
        limits = np.searchsorted(term[order], np.arange(len(names) + 1))
        yield ids, names, limits, item[order]


def automaton(terms: list[str]) -> ahocorasick.Automaton:
    """Patterns are a term's bytes between two guards, a character a byte."""
    made = ahocorasick.Automaton()
    guard = chr(GUARD)
    for n, term in enumerate(terms):
        made.add_word(guard + term.encode().decode("latin-1") + guard, n)
    made.make_automaton()
    return made


def scanned(data: np.ndarray, offsets: np.ndarray, found: ahocorasick.Automaton, size: int) -> tuple[np.ndarray, ...]:
    """(terms of each row with repeats, row, term and count of each automaton term that occurs)."""
    rows = len(offsets) - 1
    # a guard before every row and one at the end, so that terms never run across rows
    text = np.full(len(data) + rows + 1, GUARD, dtype=np.uint8)
    starts = offsets[:-1] + np.arange(1, rows + 1)
    place = np.ones(len(text), dtype=bool)
    place[offsets[:-1] + np.arange(rows)] = False
    place[-1] = False
    text[place] = FOLDED[data]
    inside = text != GUARD
    begins = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    total = np.diff(np.searchsorted(begins, np.append(starts, len(text))))
    hits = np.fromiter(chain.from_iterable(found.iter(text.tobytes().decode("latin-1"))), np.int64).reshape(-1, 2)
    row = np.searchsorted(starts, hits[:, 0] - 1, "right") - 1  # the guard after the term may start the next row
    keys = np.sort(row * size + hits[:, 1])
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return total, keys[first] // size, keys[first] % size, np.diff(np.append(first, len(keys)))


def pieces(data: np.ndarray, size: int) -> np.ndarray:
    """Limits of pieces of at least ``size`` bytes (the last may be shorter) that cut no term."""
    limits = [0]
    while len(data) - limits[-1] > size:
        at = limits[-1] + size
        while at < len(data) and IS_TERM[data[at : at + size]].all():
            at += size
        limits.append(at + int(IS_TERM[data[at : at + size]].argmin()) if at < len(data) else len(data))
    return np.array(limits + [len(data)] * (limits[-1] < len(data) or len(limits) == 1))


def scanned_long(data: np.ndarray, found: ahocorasick.Automaton, size: int) -> tuple[np.ndarray, ...]:
    """As ``scanned``, for one long row, in pieces."""
    limits, n, counts = pieces(data, LONG_BYTES), 0, np.zeros(size, dtype=np.int64)
    for a, b in zip(limits, limits[1:]):
        total, _, term, times = scanned(data[a:b], np.array([0, b - a]), found, size)
        n += int(total[0])
        counts[term] += times
    term = np.flatnonzero(counts)
    return np.array([n]), np.zeros(len(term), dtype=np.int64), term, counts[term]


def count_terms(docs: DataFrame, terms: list[str], id_col: str, text_col: str) -> DataFrame:
    """Per document with a term: id, ``n`` (its terms with repeats), ``terms`` and ``times`` (32-bit little-endian)."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, found = len(shared.value), automaton(shared.value)
        for batch in tidy(batches):
            for a, b, data, offsets in text_slices(batch.column(1), SCAN_BYTES):
                if len(data) > 2 * LONG_BYTES:  # one row: slices hold several only within their budget
                    total, row, term, times = scanned_long(data, found, size)
                else:
                    total, row, term, times = scanned(data, offsets, found, size)
                at = np.searchsorted(row, np.arange(b - a + 1)).tolist()
                raw, counts = term.astype("<u4").tobytes(), times.astype("<u4").tobytes()
                cut = [(4 * x, 4 * y) for x, y in zip(at, at[1:])]
                out = pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], pa.array(total, pa.int64()),
                     pa.array([raw[x:y] for x, y in cut], pa.binary()), pa.array([counts[x:y] for x, y in cut], pa.binary())],
                    names=["id", "n", "terms", "times"],
                )
                yield out.filter(pa.array(total > 0))

    return docs.select(F.col(id_col).cast("long").alias("id"), text_col).mapInArrow(
        run, "id long, n long, terms binary, times binary"
    )


def document_frequencies(counted: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term; each task adds its own up first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(joined(batch.column(0))[0], minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["term", "df"])

    summed = counted.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    found = summed.toArrow()  # a row a term of the block
    out = np.zeros(size, dtype=np.int64)
    out[found["term"].to_numpy()] = found["df"].to_numpy()
    return out


def joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All 32-bit numbers of a binary column, and how many each row has."""
    parts = [x.as_py() for x in column]
    return np.frombuffer(b"".join(parts), "<u4").astype(np.int64), np.array([len(p) // 4 for p in parts], dtype=np.int64)


def best_rows(found: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` best rows of each item."""
    ordered = found.sort_values(["item", "score", "known", "doc"], ascending=[True, False, True, True], kind="stable")
    return ordered[ordered.groupby("item").cumcount() < k]


def scored(counted: DataFrame, weights: np.ndarray, limits: np.ndarray, items: np.ndarray, n_docs: int, length: int, k: int) -> DataFrame:
    """Each task's best documents of each item: item (number), known, doc, score."""
    spread = np.diff(limits)
    shared = counted.sparkSession.sparkContext.broadcast((weights, limits, items, spread))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, limits, items, spread = shared.value
        n_items = int(items.max()) + 1
        best = pd.DataFrame({"item": [], "score": [], "known": [], "doc": []}, dtype=np.int64)
        worst = np.zeros(n_items, dtype=np.int64)  # the k-th score of each item so far
        for batch in tidy(batches):
            all_terms, widths = joined(batch.column(2))
            all_times, _ = joined(batch.column(3))
            at = np.concatenate([[0], np.cumsum(widths)])
            work = np.concatenate([[0], np.cumsum(spread[all_terms])])[at] + n_items * np.arange(batch.num_rows + 1)
            for a, b in slices(work, SCORE_CELLS):
                part, sizes = batch.slice(a, b - a), widths[a:b]
                term, times = all_terms[at[a] : at[b]], all_times[at[a] : at[b]]
                row = np.repeat(np.arange(part.num_rows), sizes)
                m = 10 + (90 * part.column(1).to_numpy() * n_docs) // length
                gain = weights[term] * ((1_000_000_000 * times) // (1000 * times + 8 * m[row]))
                each = spread[term]
                ends = np.cumsum(each)
                place = np.repeat(limits[term] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)
                score = np.zeros(part.num_rows * n_items, dtype=np.int64)
                np.add.at(score, np.repeat(row * n_items, each) + items[place], np.repeat(gain, each))
                held = np.flatnonzero((score > 0) & (score >= np.tile(worst, part.num_rows)))
                own = part.column(0)
                docs = own.fill_null(0).to_numpy()[held // n_items]
                known = own.is_valid().to_numpy(zero_copy_only=False).astype(np.int64)[held // n_items]
                more = pd.DataFrame({"item": held % n_items, "score": score[held], "known": known, "doc": docs})
                best = best_rows(pd.concat([best, more]), k)
                full = best.groupby("item").agg(n=("score", "size"), low=("score", "min"))
                full = full[full["n"] == k]
                worst[full.index.to_numpy(np.int64)] = full["low"].to_numpy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(best["item"].to_numpy(np.int64)), pa.array(best["doc"].to_numpy(np.int64), mask=best["known"].to_numpy() == 0),
             pa.array(best["score"].to_numpy(np.int64))],
            names=["item", "doc", "score"],
        )

    return counted.select("id", "n", "terms", "times").mapInArrow(run, "item long, doc long, score long")


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)


def rank_documents(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", k: int = 10, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Each item's ``k`` best documents: item id, ``rank`` (from 1), document id, ``score``."""
    spark = docs.sparkSession
    bound_batches(spark)
    out = spark.createDataFrame([], "item long, rank int, doc long, score long")
    for ids, terms, limits, held in item_blocks(items, item_col, item_text_col, block_bytes):
        counted = store(count_terms(docs, terms, id_col, text_col), "term-counts")
        n_docs, length = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            break
        weights = term_weights(document_frequencies(counted, len(terms)), n_docs)
        local = scored(counted, weights, limits, held, n_docs, length, k).withColumn("part", F.spark_partition_id() % 64)
        for by in (["item", "part"], ["item"]):
            order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_first("doc"))
            local = local.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        names = spark.createDataFrame(list(enumerate(ids)), "item long, own long")
        out = out.unionByName(local.join(names, "item").select(F.col("own").alias("item"), "rank", "doc", "score"))
    return out.select(F.col("item").alias(item_col), "rank", F.col("doc").alias(id_col), "score")
