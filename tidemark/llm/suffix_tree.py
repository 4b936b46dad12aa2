"""Language-model scoring with a probabilistic suffix tree.

A text is read as a stream of bytes: its lower-cased words, each followed by a space, then an end mark.
The tree's states are byte contexts of up to ``depth`` bytes. All n-grams of the training texts are
counted and kept, so the model grows with the corpus. A context is kept as a state if it occurs at least
``state_times`` times and its next-symbol distribution diverges from its suffix's by enough nats in total.
Distributions are smoothed towards the suffix's with an escape mass for what the context has not shown
(Witten-Bell), and each symbol is scored in the longest kept suffix of what precedes it.

The longest n-grams are dealt out by the last ``NEAR`` bytes of their context. An n-gram, its context and
all their suffixes down to that length are then in one task, which decides the states there; the n-grams of
up to ``NEAR`` - 1 context bytes, whose number the alphabet bounds, go to all tasks. The scores of frequent
n-grams go to all tasks as well (a matter of cost only); each text's other n-grams are sent to the tasks
that hold the states.

The words are counted too, for the unigram base score. Counts of frequent words (bounded by a share, for
cost only) go to all tasks; the rare words of each text are joined with the whole table of counts.

Defined results: a null or empty text is the end mark alone, learned and scored like others; with no
training text every base token has probability one and every symbol is uniform; repeated rows count
each; null ids belong to the training part; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import LOWER, Words, bound_batches, codes_of, shuffle_parts, store, text_slices, tidy

END, BEFORE, KINDS = 10, 0, 257
HOLD = 4_000_000  # distinct n-grams a task gathers before it passes them on
ROWS_OUT = 100_000  # counts in a batch
COUNT_BYTES = 1 << 20  # of text counted at a time
NEAR = 3  # context bytes by which n-grams are dealt out
ASKED = 1_000_000  # n-grams of texts scored at a time


@dataclass(frozen=True)
class TreeModelRules:
    depth: int = 6
    state_times: int = 2  # a state's context occurs at least so often
    state_share: float = 0.0  # of all symbols: the same as a share; 0 refuses none
    entry_share: float = 0.0  # of all symbols: an n-gram kept in the tree occurs at least so often; 0 keeps all
    divergence: float = 1.0  # nats a next symbol, over all occurrences
    escape_weight: float = 4.0  # occurrences that each next symbol adds to the escape mass
    word_share: float = 1e-6  # of all tokens: words whose counts go to all tasks
    gram_share: float = 5e-8  # of all symbols: n-grams whose scores go to all tasks


def symbol_stream(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, Words, np.ndarray]:
    """(symbols of all rows, row limits, words, lower-cased bytes) of a slice."""
    low = LOWER[data]
    words = Words(low, offsets)
    sizes = words.ends - words.starts
    rows = len(offsets) - 1
    place = np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)) + words.row, sizes)
    ends = np.concatenate([[0], np.cumsum(sizes + 1)])[words.first[1:]] + np.arange(rows)
    out = np.full(int((sizes + 1).sum()) + rows, 32, dtype=np.uint8)
    out[place] = low[words.inside]
    out[ends] = END
    return out, np.append(0, ends + 1), words, low


def windows(symbols: np.ndarray, limits: np.ndarray, depth: int) -> np.ndarray:
    """Each symbol with the ``depth`` symbols before it, the symbol itself in the highest byte."""
    key = np.zeros(len(symbols), dtype=np.uint64)
    since = (np.arange(len(symbols)) - np.repeat(limits[:-1], np.diff(limits))).clip(max=depth).astype(np.int8)
    for back in range(depth + 1):
        own = symbols[: len(symbols) - back].astype(np.uint64)
        own[since[back:] < back] = BEFORE
        own <<= np.uint64(8 * (depth - back))
        key[back:] |= own
    return key


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key)
    key, count = key[order], count[order]
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[starts], np.add.reduceat(count, starts) if len(starts) else count


def all_orders(key: np.ndarray, count: np.ndarray, depth: int, first: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Counts of the n-grams of every order from ``first`` on, tagged with the order in the top byte."""
    for order in range(first, depth + 1):
        short = key >> np.uint64(8 * (depth - order))
        starts = np.flatnonzero(np.append(True, short[1:] != short[:-1]))[: len(short)]
        yield short[starts] | np.uint64(order << 56), np.add.reduceat(count, starts) if len(starts) else count


def word_hashes(words: pa.Array) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in words.to_pylist()), np.uint64, len(words)).view(np.int64)


def corpus_counts(df: DataFrame, text_col: str, rules: TreeModelRules) -> DataFrame:
    """(kind, key, times) over all rows: kind 0 longest n-grams, 1 words by hash, 2 texts, 3 short n-grams."""
    bound_batches(df.sparkSession)
    depth = rules.depth
    short = depth - least_orders(depth)

    def rows(kind: int, key: np.ndarray, times: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(key), ROWS_OUT):
            own = key[a : a + ROWS_OUT]
            columns = [np.full(len(own), kind, dtype=np.int8), own.view(np.int64), times[a : a + ROWS_OUT].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["kind", "key", "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, words, texts = ([], []), ([], []), 0
        for batch in tidy(batches):
            for a, b, data, offsets in text_slices(batch.column(0), COUNT_BYTES):
                texts += b - a
                symbols, limits, found, low = symbol_stream(data, offsets)
                key, count = np.unique(windows(symbols, limits, depth), return_counts=True)
                grams[0].append(key)
                grams[1].append(count)
                codes, kinds = codes_of(found.arrow(low))
                words[0].append(word_hashes(kinds))
                words[1].append(np.bincount(codes, minlength=len(kinds)))
                for kind, held in ((0, grams), (1, words)):
                    if sum(map(len, held[0])) > HOLD:
                        now = merged(*held)
                        if len(now[0]) > HOLD * 3 // 4:
                            yield from rows(kind, *now)
                            if kind == 0:
                                yield from rows(3, *merged([now[0] >> np.uint64(8 * short)], [now[1]]))
                            now = (now[0][:0], now[1][:0])
                        held[0][:], held[1][:] = [now[0]], [now[1]]
        if grams[0]:
            now = merged(*grams)
            yield from rows(0, *now)
            yield from rows(3, *merged([now[0] >> np.uint64(8 * short)], [now[1]]))
            yield from rows(1, *merged(*words))
            yield from rows(2, np.zeros(1, np.int64), np.array([texts]))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {kind: ([], []) for kind in range(4)}
        waiting = 0
        for batch in tidy(batches):
            kinds, key, times = (batch.column(k).to_numpy() for k in range(3))
            for kind in np.unique(kinds).tolist():
                own = kinds == kind
                held[kind][0].append(key[own])
                held[kind][1].append(times[own])
            waiting += len(key)
            if waiting > HOLD:
                held = {kind: tuple([x] for x in merged(*x)) if x[0] else x for kind, x in held.items()}
                waiting = 0
        for kind, x in held.items():
            if x[0]:
                yield from rows(kind, *merged(*x))

    found = df.select(text_col).mapInArrow(run, "kind byte, key long, times long")
    place = F.when(F.col("kind") == 0, near(depth)).otherwise(F.col("key"))
    dealt = found.repartition(shuffle_parts(df.sparkSession), "kind", place)
    return store(dealt.mapInArrow(add_up, "kind byte, key long, times long"), "pst-counts")


def least_orders(depth: int) -> int:
    """The longest order whose n-grams go to all tasks."""
    return min(NEAR - 1, depth)


def near(depth: int) -> Column:
    """The last ``NEAR`` bytes of the context of a longest n-gram."""
    drop = max(0, depth - NEAR)
    return F.shiftrightunsigned("key", 8 * drop).bitwiseAND(F.lit((1 << (8 * min(NEAR, depth))) - 1))


@dataclass
class SuffixTree:
    """Per order: kept contexts with their escape shares, and their entries with probabilities."""

    depth: int
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]
    entries: list[np.ndarray]
    chances: list[np.ndarray]

    def scores(self, key: np.ndarray) -> np.ndarray:
        """log10 of each sorted window's last symbol in its longest kept suffix."""
        p = np.full(len(key), 1 / KINDS)
        for order in range(self.depth + 1):
            if not len(self.contexts[order]):
                continue
            short = key >> np.uint64(8 * (self.depth - order))
            state, kept = find(self.contexts[order], short & np.uint64((1 << (8 * order)) - 1))
            entry, seen = find(self.entries[order], short)
            p = np.where(seen, self.chances[order][entry], np.where(kept, self.escapes[order][state] * p, p))
        return np.log10(p)


def find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a sorted table, and whether the value is there."""
    if not len(table):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return at, table[at] == wanted


@dataclass
class Grown:
    """The n-grams of the last order that was grown, for the order after it."""

    entry: np.ndarray
    count: np.ndarray
    chance: np.ndarray
    full: np.ndarray  # occurrences of each n-gram's context


def grow(
    key: np.ndarray, times: np.ndarray, texts: int, rules: TreeModelRules, total: int, orders: range, above: Grown | None = None
) -> tuple[SuffixTree, Grown | None]:
    """The states of some orders from all tagged n-grams of these orders; ``above`` is the order before."""
    tree = SuffixTree(rules.depth, [], [], [], [])
    order_of = key >> np.uint64(56)
    for order in orders:
        own = order_of == order
        entry, count = key[own] & np.uint64((1 << 56) - 1), times[own].astype(np.float64)
        sort = np.argsort(entry)
        entry, count = entry[sort], count[sort]
        context, state = np.unique(entry & np.uint64((1 << (8 * order)) - 1), return_inverse=True)
        full = np.bincount(state, count, minlength=len(context))
        if order:
            full = np.where(context == BEFORE, np.maximum(full, texts), full)
        held = count >= rules.entry_share * total
        entry, count, state = entry[held], count[held], state[held]
        kinds = np.bincount(state, minlength=len(context))
        shown = np.bincount(state, count, minlength=len(context))
        if order == 0:
            keep = np.ones(len(context), dtype=bool)
            under = np.full(len(entry), 1 / KINDS)
        else:
            at, _ = find(above.entry, entry >> np.uint64(8))
            under = above.chance[at]
            # the suffix's own distribution, from its counts
            plain = above.count[at] / np.maximum(1.0, above.full[at])
            gain = np.bincount(state, count * np.log((count / full[state]) / plain), minlength=len(context))
            keep = (full >= max(rules.state_times, rules.state_share * total)) & (gain >= rules.divergence * kinds)
        more = rules.escape_weight * kinds
        with np.errstate(invalid="ignore"):
            escape = np.where(full + more > 0, (full - shown + more) / (full + more), 1.0)
        mixed = (count + (full - shown + more)[state] * under) / (full + more)[state]
        chance = np.where(keep[state], mixed, under)
        tree.contexts.append(context[keep])
        tree.escapes.append(escape[keep])
        tree.entries.append(entry[keep[state]])
        tree.chances.append(chance[keep[state]])
        above = Grown(entry, count, chance, full[state])
    return tree, above


def grow_tree(key: np.ndarray, times: np.ndarray, texts: int, rules: TreeModelRules) -> SuffixTree:
    """The whole tree from the tagged n-grams of all orders."""
    total = int(times[key >> np.uint64(56) == 0].sum())
    return grow(key, times, texts, rules, total, range(rules.depth + 1))[0]


@dataclass
class Base:
    """What every task knows of the model: the short orders, and the counts of symbols and texts."""

    tree: SuffixTree
    last: Grown
    total: int
    texts: int

    def whole(self, key: np.ndarray, times: np.ndarray, rules: TreeModelRules) -> SuffixTree:
        """The tree over the given longest n-grams (all of their dealt-out place), sorted by key."""
        first, short = least_orders(rules.depth) + 1, self.tree
        if first > rules.depth or not len(key):
            none = [np.zeros(0, np.uint64)] * (rules.depth + 1 - first), [np.zeros(0)] * (rules.depth + 1 - first)
            long = SuffixTree(rules.depth, none[0], none[1], none[0], none[1])
        else:
            grams = map(np.concatenate, zip(*all_orders(key, times, rules.depth, first)))
            long, _ = grow(*grams, self.texts, rules, self.total, range(first, rules.depth + 1), self.last)
        return SuffixTree(
            rules.depth, short.contexts + long.contexts, short.escapes + long.escapes, short.entries + long.entries,
            short.chances + long.chances,
        )


def numbers(df: DataFrame) -> list[np.ndarray]:
    """The integer columns of a bounded table as arrays."""
    found = df.toArrow()
    return [found.column(k).to_numpy().astype(np.int64) for k in range(found.num_columns)]


def base_orders(key: np.ndarray, times: np.ndarray, texts: int, rules: TreeModelRules) -> Base:
    """The short orders, from the sorted n-grams of the longest of them."""
    short, total = least_orders(rules.depth), int(times.sum())
    grams = [np.concatenate(x) for x in zip(*all_orders(key, times, short))]
    tree, last = grow(*grams, texts, rules, total, range(short + 1))
    return Base(tree, last, total, texts)


def frequent_scores(grams: DataFrame, model: Broadcast, rules: TreeModelRules) -> tuple[np.ndarray, np.ndarray]:
    """Sorted longest n-grams that make up ``gram_share`` of the symbols, and their scores."""
    least = max(1, rules.gram_share * model.value.total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, times = merged(*gathered(batches))
        if len(key):
            often = key[times >= least]
            score = model.value.whole(key, times, rules).scores(often)
            yield pa.RecordBatch.from_arrays([pa.array(often.view(np.int64)), pa.array(score)], names=["key", "score"])

    dealt = grams.repartition(shuffle_parts(grams.sparkSession), near(rules.depth))
    found = dealt.mapInArrow(run, "key long, score double").toArrow()
    key, score = found.column(0).to_numpy().astype(np.int64).view(np.uint64), found.column(1).to_numpy()
    order = np.argsort(key)
    return key[order], score[order]


def gathered(batches: Iterator[pa.RecordBatch]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for batch in tidy(batches):
        keys.append(batch.column(0).to_numpy().view(np.uint64))
        counts.append(batch.column(1).to_numpy())
    return keys, counts


def asked_scores(grams: DataFrame, asked: DataFrame, model: Broadcast, rules: TreeModelRules) -> DataFrame:
    """(row, score) for each of the asked n-grams (key, times, row)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, keys, counts, held, waiting = None, [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [], 0

        def answers() -> pa.RecordBatch:
            key, times, row = (np.concatenate(x) for x in zip(*held))
            kinds, where = np.unique(key.view(np.uint64), return_inverse=True)
            score = pa.array(tree.scores(kinds)[where] * times)
            return pa.RecordBatch.from_arrays([pa.array(row), score], names=["row", "score"])

        for batch in tidy(batches):  # the model's n-grams come first
            key, times, row = (batch.column(k).to_numpy() for k in range(3))
            learned = int(np.searchsorted(row >= 0, True))
            if learned:
                keys.append(key[:learned].view(np.uint64))
                counts.append(times[:learned])
            if learned < len(key):
                if tree is None:
                    tree = model.value.whole(*merged(keys, counts), rules)
                held.append((key[learned:], times[learned:], row[learned:]))
                waiting += len(key) - learned
            if waiting > ASKED:
                yield answers()
                held, waiting = [], 0
        if held:
            yield answers()

    both = grams.select("key", "times", F.lit(-1).cast("long").alias("row")).unionByName(asked)
    dealt = both.repartition(shuffle_parts(grams.sparkSession), near(rules.depth))
    return dealt.sortWithinPartitions(F.col("row") >= 0).mapInArrow(run, "row long, score double")


def score_texts(
    df: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", rules: TreeModelRules = TreeModelRules()
) -> DataFrame:
    """Per row: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``."""
    spark = df.sparkSession
    counts = corpus_counts(df.filter(train), text_col, rules)
    sums = {r["kind"]: r for r in counts.groupBy("kind").agg(F.sum("times").alias("n"), F.count("*").alias("v")).collect()}
    texts = int(sums[2]["n"]) if 2 in sums else 0
    tokens = (int(sums[1]["n"]) if 1 in sums else 0) + texts
    distinct = (int(sums[1]["v"]) if 1 in sums else 0) + (texts > 0)
    below = tokens + 0.5 * (distinct + 1)
    found = numbers(counts.filter(F.col("kind") == 3).select("key", "times"))
    sort = np.argsort(found[0].view(np.uint64))
    base = base_orders(found[0].view(np.uint64)[sort], found[1][sort], texts, rules)
    model = spark.sparkContext.broadcast(base)
    grams = counts.filter(F.col("kind") == 0).select("key", "times")
    cached = frequent_scores(grams, model, rules)
    words = counts.filter(F.col("kind") == 1).select("key", "times")
    often = numbers(words.filter(F.col("times") >= max(1, rules.word_share * tokens)))
    order = np.argsort(often[0])
    shared = spark.sparkContext.broadcast((*cached, often[0][order], often[1][order]))
    end_score = float(np.log10((texts + 0.5) / below))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, chances, known, times = shared.value
        gain = np.log10((times + 0.5) / below)
        for batch in tidy(batches):
            for a, b, data, offsets in text_slices(batch.column(2)):
                symbols, limits, found, low = symbol_stream(data, offsets)
                key, where = np.unique(windows(symbols, limits, rules.depth), return_inverse=True)
                at, met = find(grams, key)
                value = np.where(met, chances[at], 0.0) if len(grams) else np.zeros(len(key))
                score = np.add.reduceat(value[where], limits[:-1])
                asked = np.flatnonzero(~met[where])
                row_of = np.repeat(np.arange(b - a), np.diff(limits))[asked]
                code, often = np.unique(row_of * len(key) + where[asked], return_counts=True)
                lots = np.searchsorted(code // len(key), np.arange(b - a + 1)).astype(np.int32)
                grams_asked = pa.ListArray.from_arrays(pa.array(lots), pa.array(key[code % len(key)].view(np.int64)))
                times_asked = pa.ListArray.from_arrays(pa.array(lots), pa.array(often.astype(np.int32)))
                codes, kinds = codes_of(found.arrow(low))
                hashes = word_hashes(kinds)
                at, seen = find(known, hashes)
                seen, rows = seen[codes], b - a
                value = gain[at[codes]] if len(known) else np.zeros(len(codes))
                base = np.bincount(found.row[seen], value[seen], minlength=rows) + end_score
                number = np.bincount(found.row[seen], minlength=rows) + (texts > 0)
                rare = np.flatnonzero(~seen)
                ends = np.searchsorted(found.row[rare], np.arange(rows + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes[codes[rare]] if len(kinds) else np.zeros(0, np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], batch.column(1)[a:b], pa.array(found.counts + 1), pa.array(number), pa.array(base), pa.array(score), lists, grams_asked, times_asked],
                    names=["id", "train", "n_tokens", "n_known", "base_score", "score", "rare", "asked", "often"],
                )

    fields = [T.StructField("id", df.schema[id_col].dataType), T.StructField("train", T.BooleanType())]
    fields += [T.StructField(k, T.LongType()) for k in ("n_tokens", "n_known")]
    fields += [T.StructField(k, T.DoubleType()) for k in ("base_score", "score")]
    fields += [T.StructField(k, T.ArrayType(T.LongType())) for k in ("rare", "asked")]
    fields += [T.StructField("often", T.ArrayType(T.IntegerType()))]
    marked = df.select(F.col(id_col).alias("id"), train.alias("train"), F.col(text_col).alias("text"))
    scored = marked.mapInArrow(run, T.StructType(fields)).withColumn("row", F.monotonically_increasing_id())
    scored = store(scored, "pst-scores")

    rare = scored.select("row", F.explode("rare").alias("key")).groupBy("row", "key").agg(F.count("*").alias("n"))
    less = words.filter(F.col("times") < max(1, rules.word_share * tokens))
    met = rare.join(less, "key", "left").withColumn("c", F.coalesce("times", F.lit(0)))
    more = met.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * F.log10((F.col("c") + 0.5) / F.lit(below))).alias("more_base"),
    )
    asked = scored.select("row", F.explode(F.arrays_zip("asked", "often")).alias("gram"))
    asked = asked.select(F.col("gram.asked").alias("key"), F.col("gram.often").cast("long").alias("times"), "row")
    lots = asked_scores(grams, asked, model, rules).groupBy("row").agg(F.sum("score").alias("more_score"))
    joined = scored.drop("rare", "asked", "often").join(more, "row", "left").join(lots, "row", "left")
    return joined.select(
        F.col("id").alias(id_col), (~F.col("train")).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )
