"""Quality rules: how much of a text lies inside repeated word n-grams and repeated lines.

Words become exact integer codes (an Arrow dictionary), n-grams become rolling 64-bit hashes of
those codes, both for a whole slice of texts at once; a text's row number is mixed into its hashes,
so one pass finds the repeats of all texts. Longer n-grams are only looked for where the next
shorter one repeats.

Defined results: a null or empty text has zero words and fails the base rule; repeated rows and
tied values are measured independently; other columns are never read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import Words, bound_batches, codes_of, mixed, packed, repeated, text_slices, tidy

BASE_LENGTH = 5
ROLL = np.uint64(0x9E3779B97F4A7C15)
IS_SYMBOL = np.zeros(256, dtype=bool)
IS_SYMBOL[list(b"#*$%&|<>")] = True
IS_PUNCTUATION = np.zeros(256, dtype=bool)
IS_PUNCTUATION[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line_chars", "run_words", "echo_words", "top_word")


@dataclass(frozen=True)
class QualityRules:
    """Limits on shares. ``gram_shares``: n-gram length to the share of word characters inside repeats."""

    min_words: int = 10
    repeat_percent: int = 20
    gram_shares: tuple[tuple[int, float], ...] = ((5, 0.30), (6, 0.28), (7, 0.26), (8, 0.24), (9, 0.22), (10, 0.20))
    line_share: float = 0.40  # characters of lines equal to an earlier line
    run_share: float = 0.30  # words holding a doubled punctuation mark
    echo_share: float = 0.30  # words equal to the word before them
    top_share: float = 0.25  # the most frequent word among the words


def measure(data: np.ndarray, offsets: np.ndarray, lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    """Counts per text of a slice; ``gram_n`` is word characters inside n-grams found twice or more."""
    rows = len(offsets) - 1
    words = Words(data, offsets)
    lead = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    sizes = lead[words.ends] - lead[words.starts]
    per_row = lambda keep, weight=None: np.bincount(
        words.row[keep] if keep is not None else words.row,
        None if weight is None else weight[keep] if keep is not None else weight,
        minlength=rows,
    ).astype(np.int64)
    out = {"n_words": words.counts.astype(np.int64), "word_chars": per_row(None, sizes)}
    symbols = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(IS_SYMBOL[data], out=symbols[1:])
    out["n_symbols"] = np.diff(symbols[offsets])
    out |= line_repeats(data, offsets, words, lead)

    double = np.zeros(len(data) + 1, dtype=np.int64)
    if len(data):
        np.cumsum(IS_PUNCTUATION[data[1:]] & (data[1:] == data[:-1]), out=double[2:])
    runs = double[words.ends] > double[np.minimum(words.starts + 1, len(data))]
    out["run_words"] = per_row(runs)

    codes, _ = codes_of(words.arrow(data))
    echo = np.zeros(len(codes), dtype=bool)
    echo[1:] = (codes[1:] == codes[:-1]) & (words.row[1:] == words.row[:-1])
    out["echo_words"] = per_row(echo)
    own = (words.row.astype(np.uint64) << np.uint64(32)) | codes.astype(np.uint64)
    out["top_word"] = np.zeros(rows, dtype=np.int64)
    kinds, times = np.unique(own, return_counts=True)
    np.maximum.at(out["top_word"], (kinds >> np.uint64(32)).astype(np.int64), times)

    hashed = mixed(codes.astype(np.uint64) + np.uint64(1))
    salt = mixed(words.row.astype(np.uint64) + ROLL)
    left = words.first[1:][words.row] - np.arange(len(codes))  # words from here to the end of the text
    at = np.flatnonzero(left >= lengths[0]) if len(codes) else np.zeros(0, np.int64)
    roll = np.zeros(len(at), dtype=np.uint64)
    for k in range(lengths[0]):
        roll = roll * ROLL + hashed[at + k]
    n = lengths[0]
    while True:
        twice = repeated(mixed(roll ^ salt[at]))
        at, roll = at[twice], roll[twice]
        if n in lengths:
            step = np.zeros(len(codes) + n + 1, dtype=np.int64)
            step[at] += 1
            step[at + n] -= 1
            covered = np.cumsum(step)[: len(codes)] > 0
            out[f"gram_{n}"] = per_row(covered, sizes)
            if n == BASE_LENGTH:
                out["n_repeat_words"] = per_row(covered)
        if n == lengths[-1]:
            return out
        fits = left[at] > n
        at = at[fits]
        roll = roll[fits] * ROLL + hashed[at + n]
        n += 1


def line_repeats(data: np.ndarray, offsets: np.ndarray, words: Words, lead: np.ndarray) -> dict[str, np.ndarray]:
    """Lines with a word that equal an earlier line of their text: their number and characters."""
    rows = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    row = np.sort(
        np.concatenate([np.arange(rows), np.searchsorted(offsets, breaks, "right") - 1]), kind="stable"
    )
    ends = np.sort(np.concatenate([offsets[1:], breaks]), kind="stable")
    worded = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    codes, _ = codes_of(packed(data[data != 10], ends - starts))
    again = repeated((row.astype(np.uint64) << np.uint64(32)) | codes.astype(np.uint64), later_only=True) & worded
    chars = lead[ends] - lead[starts]
    return {
        "n_dup_lines": np.bincount(row[again], minlength=rows).astype(np.int64),
        "line_chars": np.bincount(row[again], chars[again], minlength=rows).astype(np.int64),
    }


def verdicts(m: dict[str, np.ndarray], rules: QualityRules) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept) for measured texts."""
    base = (m["n_words"] < rules.min_words) | (100 * m["n_repeat_words"] > rules.repeat_percent * m["n_words"])
    bad = m["line_chars"] > rules.line_share * m["word_chars"]
    bad |= m["run_words"] > rules.run_share * m["n_words"]
    bad |= m["echo_words"] > rules.echo_share * m["n_words"]
    bad |= m["top_word"] > rules.top_share * np.maximum(m["n_words"], 20)
    for n, share in rules.gram_shares:
        bad |= m[f"gram_{n}"] > share * m["word_chars"]
    return base, ~base & ~bad


def lengths_of(rules: QualityRules) -> tuple[int, ...]:
    return tuple(sorted({BASE_LENGTH} | {n for n, _ in rules.gram_shares}))


def quality_report(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: QualityRules = QualityRules()
) -> DataFrame:
    """One row per input row: id, counts, share columns, ``base_failed`` and ``kept``."""
    lengths = lengths_of(rules)
    grams = [f"gram_{n}" for n in lengths]
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tidy(batches):
            for a, b, data, offsets in text_slices(batch.column(1)):
                m = measure(data, offsets, lengths)
                base, kept = verdicts(m, rules)
                columns = [batch.column(0)[a:b], *(pa.array(m[k]) for k in MEASURES), *(pa.array(m[k]) for k in grams)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(base), pa.array(kept)], names=names)

    names = [id_col, *MEASURES, *grams, "base_failed", "kept"]
    fields = [T.StructField(id_col, df.schema[id_col].dataType)]
    fields += [T.StructField(k, T.LongType()) for k in (*MEASURES, *grams)]
    fields += [T.StructField(k, T.BooleanType()) for k in ("base_failed", "kept")]
    return df.select(id_col, text_col).mapInArrow(run, T.StructType(fields))


def keep_good(df: DataFrame, text_col: str = "text", rules: QualityRules = QualityRules()) -> DataFrame:
    """The rows whose text passes, all columns unchanged."""
    lengths, at = lengths_of(rules), df.columns.index(text_col)
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tidy(batches):
            for a, b, data, offsets in text_slices(batch.column(at)):
                _, kept = verdicts(measure(data, offsets, lengths), rules)
                yield batch.slice(a, b - a).filter(pa.array(kept))

    return df.mapInArrow(run, df.schema)
