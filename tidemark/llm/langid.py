"""Language identification: averaged hashed subword embeddings under a linear softmax.

Features are byte n-grams of the lower-cased text that do not cross a word gap, hashed into a fixed
number of buckets. A text's hidden vector is the mean of its buckets' embeddings. Embeddings and
softmax are trained by stochastic gradient descent in numpy on a bounded sample of labelled rows
(``sample_rows`` per language, ``max_languages`` languages; executors reduce each sampled text to its
bucket counts first). A held-back part of the sample sets the temperature of the scores and the score
below which a text is rejected. Prediction adds up one table row per n-gram.

A softmax must choose among the languages it knows, so a second figure tells how much a text is like the one it
chose: the mean log probability of its n-grams of letters under that language's own bucket frequencies. Its
limit is a low quantile of the held-back rows of the language less a slack, and less ``margin`` standard errors
of a mean over so few n-grams; noise and languages that were never learned lie below it.

Defined results: a null text or one without a letter is ``und`` with score 0 and rejected; with no
labelled row every text is; equal texts get equal results; null ids and extra columns are fine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import IS_GAP, LOWER, bound_batches, text_slices, tidy

UNKNOWN = "und"
GRAMS = (2, 3, 4)
BUCKET_BITS = 14
WORK_BYTES = 1 << 20  # of text at a time: every byte takes some sixty in work arrays
SPREAD = np.uint32(0x9E3779B1)


@dataclass(frozen=True)
class LangRules:
    sample_rows: int = 600  # labelled rows per language, in expectation
    max_languages: int = 128  # the most frequent languages are learned
    width: int = 16
    epochs: int = 12
    rate: float = 4.0
    held_back: int = 5  # every n-th sampled row calibrates instead of training
    reject_share: float = 0.001  # of the calibration rows, at most, may be rejected
    reject_below: float = 0.5  # no score above this is ever rejected
    unlike_share: float = 0.01  # quantile of the held-back rows from which the limit of likeness starts
    slack: float = 1.3  # in nats an n-gram
    margin: float = 3.0  # standard errors
    seed: int = 17


@dataclass
class LangModel:
    """``table``: bucket by language logit contributions, already divided by the temperature."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    reject: float
    likeness: np.ndarray  # bucket by language: log probability of an n-gram of letters
    limits: np.ndarray
    spreads: np.ndarray  # of the log probability of one n-gram inside a text
    margin: float = LangRules.margin
    counts: dict[str, int] = field(default_factory=dict)


def gram_buckets(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each n-gram length: bucket at every kept place, the rows' limits among these places, and whether all its
    bytes belong to letters (or to any character beyond ASCII)."""
    low = LOWER[data]
    letters = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((low >= 128) | ((low >= 97) & (low <= 122)), out=letters[1:])
    gap = IS_GAP[data]
    low = np.where(gap, np.uint8(32), low).astype(np.uint32)
    place = np.arange(len(data))
    end = np.repeat(offsets[1:], np.diff(offsets))
    gaps = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(gap, out=gaps[1:])
    for n in GRAMS:
        if len(data) < n:
            yield np.zeros(0, np.int64), np.zeros(len(offsets), np.int64), np.zeros(0, bool)
            continue
        count = len(data) - n + 1
        key = np.zeros(count, dtype=np.uint32)
        for k in range(n):
            key = (key << np.uint32(8)) | low[k : k + count]
        inner = gaps[n - 1 : n - 1 + count] - gaps[1 : 1 + count] if n > 2 else 0
        both = gap[:count] & gap[n - 1 :]
        good = np.flatnonzero((inner == 0) & ~both & (place[:count] + n <= end[:count]))
        bucket = ((key[good] ^ np.uint32(n)) * SPREAD) >> np.uint32(32 - BUCKET_BITS)
        yield bucket.astype(np.int64), np.searchsorted(good, offsets), letters[good + n] - letters[good] == n


def bucket_counts(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Buckets, their shares, and their numbers of n-grams of letters, of each text of a slice."""
    size, rows = 1 << BUCKET_BITS, len(offsets) - 1
    parts = list(gram_buckets(data, offsets))
    out = []
    for row in range(rows):
        own = np.concatenate([b[at[row] : at[row + 1]] for b, at, _ in parts])
        pure = np.concatenate([word[at[row] : at[row + 1]] for _, at, word in parts])
        counts = np.bincount(own, minlength=size)
        kinds = np.flatnonzero(counts)
        out.append((kinds, counts[kinds] / max(1, len(own)), np.bincount(own[pure], minlength=size)[kinds]))
    return out


def sample_features(df: DataFrame, lang_col: str, text_col: str, order_col: str, rules: LangRules) -> list:
    """Bounded sample of labelled rows as (language, buckets, shares, letter n-grams), the same on every run.

    The hash of the row's place in the order decides, at a rate that gives each language
    ``sample_rows`` rows; no language is shuffled or ranked as a whole.
    """
    labelled = df.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = labelled.groupBy(lang_col).count().orderBy(F.desc("count"), lang_col).limit(rules.max_languages).collect()
    if not counts:
        return []
    span = 1 << 30
    rates = {r[0]: min(span, int(span * rules.sample_rows / r[1]) + 1) for r in counts}
    pairs = [x for lang, rate in rates.items() for x in (F.lit(lang), F.lit(rate))]
    draw = F.pmod(F.xxhash64(F.lit(rules.seed), order_col), F.lit(span))
    chosen = labelled.filter(draw < F.element_at(F.create_map(*pairs), F.col(lang_col)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tidy(batches):
            for a, b, data, offsets in text_slices(batch.column(2), WORK_BYTES):
                found = bucket_counts(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], batch.column(1)[a:b],
                     pa.array([k.astype("<u2").tobytes() for k, _, _ in found], pa.binary()),
                     pa.array([w.astype("<f4").tobytes() for _, w, _ in found], pa.binary()),
                     pa.array([c.astype("<u4").tobytes() for _, _, c in found], pa.binary())],
                    names=["draw", "lang", "buckets", "shares", "letters"],
                )

    rows = chosen.select(draw.alias("draw"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).mapInArrow(
        run, "draw long, lang string, buckets binary, shares binary, letters binary"
    )
    found = sorted(rows.collect(), key=lambda r: (r["draw"], r["lang"], bytes(r["buckets"])))
    kinds = (("buckets", "<u2"), ("shares", "<f4"), ("letters", "<u4"))
    read = lambda r: [np.frombuffer(r[name], kind) for name, kind in kinds]
    return [(r["lang"], *read(r)) for r in found if len(r["buckets"])]


def fit(rows: list, rules: LangRules = LangRules()) -> LangModel:
    """Train on (language, buckets, shares, letter n-grams) rows."""
    languages = sorted({r[0] for r in rows})
    if not languages:
        nothing = np.zeros((1 << BUCKET_BITS, 0), np.float32)
        return LangModel([], nothing, np.zeros(0, np.float32), 1.0, nothing, np.zeros(0), np.zeros(0))
    place = {name: k for k, name in enumerate(languages)}
    rng = np.random.default_rng(rules.seed)
    width, count = rules.width, len(languages)
    embed = rng.uniform(-1 / width, 1 / width, (1 << BUCKET_BITS, width)).astype(np.float32)
    weights, bias = np.zeros((width, count), np.float32), np.zeros(count, np.float32)
    held = [r for k, r in enumerate(rows) if k % rules.held_back == 0]
    train = [r for k, r in enumerate(rows) if k % rules.held_back] or rows
    held = held or rows
    balance = np.bincount([place[r[0]] for r in train], minlength=count)
    balance = len(train) / count / np.maximum(balance, 1)
    for epoch in range(rules.epochs):
        step = rules.rate * (1 - epoch / rules.epochs)
        for k in rng.permutation(len(train)):
            name, buckets, shares, _ = train[k]
            hidden = shares @ embed[buckets]
            p = softmax(hidden @ weights + bias)
            p[place[name]] -= 1
            p *= np.float32(step * min(4.0, balance[place[name]]) / 4)
            back = weights @ p
            weights -= np.outer(hidden, p)
            bias -= 0.1 * p
            embed[buckets] -= np.outer(shares, back)
    logits = np.array([(r[2] @ embed[r[1]]) @ weights + bias for r in held])
    truth = np.array([place[r[0]] for r in held])
    heats = np.geomspace(0.25, 8, 41)
    loss = [-np.mean(np.log(softmax(logits / h)[np.arange(len(truth)), truth] + 1e-12)) for h in heats]
    heat = float(heats[int(np.argmin(loss))])
    top = np.sort(softmax(logits / heat).max(axis=1))
    reject = min(rules.reject_below, 0.9 * float(top[int(rules.reject_share * len(top))]))
    table = (embed @ weights / heat).astype(np.float32)
    return LangModel(languages, table, (bias / heat).astype(np.float32), reject, *likenesses(languages, train, held, rules), rules.margin)


def likenesses(languages: list[str], train: list, held: list, rules: LangRules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log probabilities of buckets, limit, spread) per language; frequencies are means over the training rows."""
    size = 1 << BUCKET_BITS
    found, limits, spreads = np.zeros((size, len(languages)), np.float32), np.zeros(len(languages)), np.zeros(len(languages))
    for k, name in enumerate(languages):
        share, rows = np.zeros(size), 0
        for _, buckets, _, letters in (r for r in train if r[0] == name and r[3].any()):
            share[buckets] += letters / letters.sum(dtype=np.int64)
            rows += 1
        found[:, k] = np.log(0.9 * share / max(1, rows) + 0.1 / size)
        own = [r for r in held if r[0] == name and r[3].any()]
        means = np.array([np.average(found[r[1], k], weights=r[3]) for r in own])
        apart = [np.average((found[r[1], k] - m) ** 2, weights=r[3]) for r, m in zip(own, means)]
        spreads[k] = np.sqrt(np.mean(apart)) if own else np.inf
        errors = rules.margin * spreads[k] * np.array([np.sqrt(len(GRAMS) / r[3].sum(dtype=np.int64)) for r in own])
        # a held-back row may lie as low as its own length allows
        limits[k] = min(0.0, float(np.quantile(means + errors, rules.unlike_share))) - rules.slack if own else -np.inf
    return found, limits, spreads


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def scores(model: LangModel, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language (index, -1 for none), its probability, and whether it is rejected, for each text of a slice."""
    rows, count = len(offsets) - 1, len(model.languages)
    if not count:
        return np.full(rows, -1), np.zeros(rows), np.ones(rows, dtype=bool)
    total, sums, grams = np.zeros(rows), np.zeros((rows, count)), list(gram_buckets(data, offsets))
    for bucket, at, _ in grams:
        total += np.diff(at)
        full = np.flatnonzero(np.diff(at))
        if len(full):
            for k in range(count):
                sums[full, k] += np.add.reduceat(model.table[:, k][bucket], at[full], dtype=np.float64)
    p = softmax(sums / np.maximum(total, 1)[:, None] + model.bias)
    best = p.argmax(axis=1)
    like, letters = np.zeros(rows), np.zeros(rows)
    for bucket, at, pure in grams:
        row = np.repeat(np.arange(rows), np.diff(at))[pure]
        like += np.bincount(row, model.likeness[bucket[pure], best[row]], minlength=rows)
        letters += np.bincount(row, minlength=rows)
    least = model.limits[best] - model.margin * model.spreads[best] * np.sqrt(len(GRAMS) / np.maximum(letters, 1))
    unlike = (letters > 0) & (like / np.maximum(letters, 1) < least)
    best[~has_letter(data, offsets)] = -1
    score = np.where(best < 0, 0.0, p[np.arange(rows), best])
    return best, score, (best < 0) | (score < model.reject) | unlike


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    ascii_letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    seen = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(ascii_letter, out=seen[1:])
    found = np.diff(seen[offsets]) > 0
    for row in np.flatnonzero(~found):
        text = data[offsets[row] : offsets[row + 1]].tobytes().decode("utf-8", "replace")
        found[row] = any(c.isalpha() for c in text)
    return found


def train_language_model(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", order_col: str = "doc_id", rules: LangRules = LangRules()
) -> LangModel:
    bound_batches(df.sparkSession)
    return fit(sample_features(df, lang_col, text_col, order_col, rules), rules)


def predict_languages(df: DataFrame, model: LangModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``lang_pred``, ``score`` and ``rejected``. The model's size is fixed by its rules."""
    bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for batch in tidy(batches):
            for a, b, data, offsets in text_slices(batch.column(1), WORK_BYTES):
                best, score, rejected = scores(model, data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], pa.array(names[best], pa.string()), pa.array(score), pa.array(rejected)],
                    names=[id_col, "lang_pred", "score", "rejected"],
                )

    fields = [T.StructField(id_col, df.schema[id_col].dataType), T.StructField("lang_pred", T.StringType())]
    fields += [T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    return df.select(id_col, text_col).mapInArrow(run, T.StructType(fields))


def keep_identified(df: DataFrame, model: LangModel, text_col: str = "text") -> DataFrame:
    """The rows whose language is not rejected, all columns unchanged."""
    bound_batches(df.sparkSession)
    at = df.columns.index(text_col)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in tidy(batches):
            for a, b, data, offsets in text_slices(batch.column(at), WORK_BYTES):
                _, _, rejected = scores(model, data, offsets)
                yield batch.slice(a, b - a).filter(pa.array(~rejected))

    return df.mapInArrow(run, df.schema)
