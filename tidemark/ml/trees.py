"""Forests and boosted trees of several row sets, grown side by side from one binned table.

Cross-validation needs the same model once per fold and once on all rows. Here the features are cut into bins
once; rows lie in blocks (bins, label, fold, running scores) of a stored table. A level of a tree is one pass:
every task adds up, for each fold's model, the two statistics of its rows per (model, node, feature, bin), and
the sums choose the splits. So one pass serves all folds and the full fit, and what leaves a task is bounded by
models, nodes, features and bins, not by rows. Statistics are whole numbers (fixed-point gradients, draws of a
bootstrap), hence the trees do not depend on how rows are spread over tasks, nor on a task that ran twice.
Every model also scores the rows it was not fitted on, so fold and test predictions come with the fit.

Where one task can hold the bins of all rows (``TreeRules.whole_bytes``), a pass would cost more than its work: a
task then reads all blocks and grows a model's boosted trees, or some trees of its forest, from end to end. Both
ways add up the same whole numbers and choose splits by the same code, so they grow the same trees.

A missing value goes to the bin of its model's own median (mode, for an ordinal), as if it had been filled
from that model's rows only. Random draws are hashes of the row's key, the model and the tree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace
from typing import ClassVar

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import drop_unused, heap_used, settle

MISSING = 255
UNIT = float(1 << 20)  # gradients are counted in parts of 2**-20
MIN_GAIN = 1e-9
BLOCKS = "keys array<{key}>, uid binary, label binary, fold binary, bins binary, margin binary"


@dataclass(frozen=True)
class TreeRules:
    """How the passes are cut; ``bins`` belongs to the model, the rest only to its cost."""

    bins: int = 64
    block_rows: int = 4096
    task_rows: int = 65_536
    histogram_bytes: int = 8 << 20
    written_every: int = 10  # boosting rounds between two stored score tables
    sums_left: int = 32  # partial sums that reach the driver
    driver_bytes: int = 2 << 20  # and their bytes, unpacked; more or longer ones are added up in tasks first
    adders: int = 6  # by so many tasks
    piece_cells: int = 8192  # sums travel in pieces of so many numbers
    passes_kept: int = 25  # passes whose broadcasts and shuffles may lie about before the driver's garbage is collected
    heap_growth: float = 0.06  # or the share of the driver's heap that may fill up first
    whole_bytes: int = 64 << 20  # bins (rows x features) up to which a task holds all rows and grows whole trees
    whole_tasks: int = 2  # such tasks a core for the forests
    chunk_rows: int = 1 << 15  # rows that such a task adds up at a time


@dataclass
class Trees:
    """Complete binary trees by node number (children of k: 2k + 1, 2k + 2); feature -1 is a leaf."""

    feature: np.ndarray
    cut: np.ndarray  # goes left if the bin is at most this
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, count: int, depth: int) -> Trees:
        nodes = (count, 2 ** (depth + 1) - 1)
        return cls(np.full(nodes, -1, np.int16), np.zeros(nodes, np.uint8), np.zeros(nodes), np.zeros(nodes))

    def importance(self, features: int, per_tree: bool) -> np.ndarray:
        """Share of the gain per feature; ``per_tree`` gives every tree the same say."""
        total = np.zeros(features)
        for feature, gain in zip(self.feature, self.gain):
            own = np.bincount(feature[feature >= 0], gain[feature >= 0], minlength=features)
            total += own / (own.sum() or 1.0) if per_tree else own
        return total / (total.sum() or 1.0)


def descended(flat: np.ndarray, base: np.ndarray, feature: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    """The node of one tree where each row arrives after ``depth`` steps; below a leaf, some node that was never open.

    ``flat`` holds the bins row by row, ``base`` the place of each row's first bin, ``feature`` no number below 0.
    """
    node = np.zeros(len(base), np.intp)
    for _ in range(depth):
        right = flat.take(base + feature.take(node)) > cut.take(node)
        node += node
        node += 1
        node += right
    return node


def bottom_values(trees: Trees, depth: int) -> np.ndarray:
    """Values (trees x nodes at ``depth``) of the leaves that the nodes lie in or below."""
    value = trees.value[:, :1]
    for level in range(depth):
        first, many = 2**level - 1, 2**level
        leaf = trees.feature[:, first : first + many, None] < 0
        below = trees.value[:, first + many : first + 3 * many].reshape(-1, many, 2)
        value = np.where(leaf, value[:, :, None], below).reshape(-1, 2 * many)
    return value


def added(start: np.ndarray, trees: Trees, bins: np.ndarray, depth: int) -> np.ndarray:
    """``start`` plus the leaf values of the trees, one after the other."""
    total, flat, base = start.copy(), bins.ravel(), np.arange(len(bins)) * bins.shape[1]
    inner, bottom = np.maximum(trees.feature, 0).astype(np.intp), bottom_values(trees, depth)
    for feature, cut, value in zip(inner, trees.cut, bottom):
        total += value.take(descended(flat, base, feature, cut, depth) - (2**depth - 1))
    return total


def stirred(x: np.ndarray, salt: int) -> np.ndarray:
    """The next state of the hash behind ``drawn``."""
    x = x ^ np.uint64((salt + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def uniform(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) / 2.0**53


def drawn(uid: np.ndarray, *salt: int) -> np.ndarray:
    """A uniform number in [0, 1) per row, fixed by its key's hash and the salt."""
    for s in salt:
        uid = stirred(uid, s)
    return uniform(uid)


# P(X <= k) of a Poisson variable with mean 1, for the number of times a bootstrap draws a row.
POISSON = np.cumsum(np.exp(-1.0) / np.array([1.0, 1, 2, 6, 24, 120, 720, 5040, 40320, 362880]))


def times_drawn(u: np.ndarray) -> np.ndarray:
    """How often a bootstrap draws the rows with these uniform numbers."""
    times = np.zeros(len(u), np.uint8)
    for bound in POISSON:
        times += u >= bound
    return times


def bin_places(values: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bin numbers of rows of feature values (NaN: missing)."""
    out = np.empty(values.shape, dtype=np.uint8)
    for j, own in enumerate(edges):
        out[:, j] = np.searchsorted(own, values[:, j], "left")
    out[np.isnan(values)] = MISSING
    return out


class Block:
    """Rows of a stored block."""

    def __init__(self, record: dict, features: int, models: int):
        self.uid = np.frombuffer(record["uid"], "<u8")
        self.label = np.frombuffer(record["label"], np.uint8)
        self.fold = np.frombuffer(record["fold"], np.int8)
        self.bins = np.frombuffer(record["bins"], np.uint8).reshape(-1, features)
        self.margin = np.frombuffer(record["margin"], "<f8").reshape(models, -1)

    def filled(self, default: np.ndarray) -> np.ndarray:
        gaps = self.bins == MISSING
        return np.where(gaps, default, self.bins) if gaps.any() else self.bins


def narrowed(total: np.ndarray) -> np.ndarray:
    """The same whole numbers in the narrowest signed type that holds them all."""
    least, most = (int(total.min()), int(total.max())) if total.size else (0, 0)
    kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= least and most <= np.iinfo(t).max)
    return total.astype(kind)


@dataclass
class Partials:
    """One array of whole numbers a task, all of a length. They travel in short pieces: long results would each
    take a large block of the driver's heap, several times over, and the heap grows with them."""

    arrays: RDD
    tasks: int
    rules: TreeRules

    def _pieces(self) -> RDD:
        cells = self.rules.piece_cells
        return self.arrays.flatMap(lambda x: [(k, narrowed(x[a : a + cells])) for k, a in enumerate(range(0, len(x), cells))])

    def collect(self) -> list[np.ndarray]:
        own: list[list[np.ndarray]] = []
        for k, piece in self._pieces().collect():
            own += [[]] if k == 0 else []
            own[-1].append(piece)
        return [np.concatenate(pieces) for pieces in own]

    def treeReduce(self, add: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        """Pieces are added up by their place, each in one task, so that the driver gets every sum once."""

        def put_together(pieces: Iterator[tuple[int, np.ndarray]]) -> Iterator[tuple[int, np.ndarray]]:
            sums: dict[int, np.ndarray] = {}
            for k, piece in pieces:
                sums[k] = add(sums[k], piece) if k in sums else piece
            yield from sums.items()

        dealt = self._pieces().partitionBy(min(self.tasks, self.rules.adders))
        return np.concatenate([piece for _, piece in sorted(dealt.mapPartitions(put_together).collect(), key=lambda x: x[0])])


@dataclass
class Records:
    """The stored blocks as records, for partition passes."""

    blocks: RDD
    tasks: int
    rules: TreeRules
    passes: int = 0
    left: int | None = None  # bytes in use after garbage was last collected here

    def mapPartitions(self, f: Callable[[Iterator], Iterator[np.ndarray]]) -> Partials:
        self.passes += 1
        used, most = heap_used(self.blocks.context)
        self.left = used if self.left is None else min(self.left, used)  # the JVM collects by itself as well
        if self.passes % self.rules.passes_kept == 0 or used - self.left > self.rules.heap_growth * most:
            drop_unused(self.blocks.context)
            self.left = heap_used(self.blocks.context)[0]
        return Partials(self.blocks.mapPartitions(f), self.tasks, self.rules)


@dataclass
class Binned:
    """The stored blocks and what belongs to them. Model number k leaves fold k out, the last leaves out none."""

    blocks: DataFrame
    edges: list[np.ndarray]
    default: np.ndarray  # models x features: the bin of a missing value
    models: int
    counts: np.ndarray  # models x 2: training rows by label
    tasks: int
    rules: TreeRules
    rows: int | None = None
    stored: DataFrame | None = None  # the same blocks as they were stored, not kept in memory

    def __post_init__(self):
        self.records = Records(self.blocks.drop("keys").rdd, self.tasks, self.rules)  # planned once: hundreds of passes read it

    @property
    def features(self) -> int:
        return len(self.edges)

    @property
    def most_bins(self) -> int:
        return max((len(e) for e in self.edges), default=0) + 1

    @property
    def in_one_task(self) -> bool:
        """Whether a task may hold the bins of all rows."""
        return self.stored is not None and self.rows * self.features <= self.rules.whole_bytes

    def held_fold(self, model: int) -> int:
        return model if model < self.models - 1 else -99


def _kept(stored: DataFrame, tasks: int) -> DataFrame:
    """Stored blocks kept in memory: hundreds of passes read them, a lost part is read again."""
    return stored.coalesce(tasks).persist(StorageLevel.MEMORY_AND_DISK)


def quantile_edges(rows: DataFrame, count: int, bins: int) -> list[np.ndarray]:
    """Ascending upper bounds of all bins but the last, from a rank sketch of each feature, in one pass."""
    probs = [k / bins for k in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(F.col("x")[j], probs, 10_000).alias(f"e{j}") for j in range(count)]).first()
    return [np.unique(np.array(found[f"e{j}"] or [], dtype=np.float64)) for j in range(count)]


def bin_rows(
    rows: DataFrame, key: str, folds: int, filled: Sequence[float], ordinals: int, rules: TreeRules = TreeRules()
) -> Binned:
    """Blocks of ``rows`` (key, label, fold, x array<double> with nulls where missing).

    A negative fold is scored but never fitted; ``folds`` = 0 fits the last model only. ``filled`` holds the
    values that the full fit puts for missing ones; the last ``ordinals`` features are ordinals.
    """
    spark, features, models = rows.sparkSession, len(filled), folds + 1
    rows = settle(rows.select(key, "label", "fold", "x"), "tree-rows")
    training = rows.where("fold >= 0")
    edges = quantile_edges(training, features, rules.bins)
    total = rows.count()
    tasks = max(1, min(-(-total // rules.block_rows), max(2 * spark.sparkContext.defaultParallelism, total // rules.task_rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, rules.block_rows):
                part = batch.slice(a, rules.block_rows)
                n = part.num_rows
                values = part.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, features)
                pieces = (
                    part.column("uid").to_numpy().astype("<u8"), part.column("label").to_numpy().astype(np.uint8),
                    part.column("fold").to_numpy().astype(np.int8), bin_places(values, edges), np.zeros((models, n), "<f8"),
                )
                keys = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), part.column(0))
                columns = [keys, *(pa.array([p.tobytes()], pa.binary()) for p in pieces)]
                yield pa.RecordBatch.from_arrays(columns, names=["keys", "uid", "label", "fold", "bins", "margin"])

    uid = F.xxhash64(F.col(key).cast("string"))
    dealt = rows.select(key, uid.alias("uid"), "label", "fold", "x").repartition(tasks, uid)
    schema = BLOCKS.format(key=rows.schema[key].dataType.simpleString())
    stored = settle(dealt.mapInArrow(run, schema), "tree-blocks")
    blocks, default = _kept(stored, tasks), np.zeros((models, features), np.uint8)
    empty = Binned(blocks, edges, default, models, np.zeros((models, 2)), tasks, rules, total, stored)
    seen = _bin_counts(empty, max(1, folds))
    counts = np.zeros((models, 2))
    for m in range(models):
        own = np.array([f != empty.held_fold(m) for f in range(max(1, folds))])
        counts[m] = seen[own, :, 0, :].sum(axis=(0, 2))  # every feature counts every row
        inside = seen[own].sum(axis=(0, 1))[:, :MISSING]
        for j in range(features):
            place = (inside[j].sum() - 1) // 2
            default[m, j] = inside[j].argmax() if j >= features - ordinals else np.searchsorted(inside[j].cumsum(), place, "right")
    whole = bin_places(np.array([filled], dtype=np.float64), edges)[0]
    default[-1] = np.where(whole == MISSING, default[-1], whole)
    empty.default, empty.counts = default, counts
    return empty


def summed(binned: Binned, count: int, of_block: Callable[[Block], np.ndarray]) -> np.ndarray:
    """Sum over all blocks of ``count`` whole numbers; many or long partial sums are added up in tasks first.

    Plain partition passes over the kept blocks: planning a query for each of them would take longer than the pass.
    Partial sums travel in the narrowest type that holds them (counts of a forest take a quarter or an eighth).
    """
    features, models = binned.features, binned.models

    def run(records: Iterator) -> Iterator[np.ndarray]:
        total = np.zeros(count, np.int64)
        for record in records:
            total += of_block(Block(record, features, models)).astype(np.int64)
        yield narrowed(total)

    parts, rules = binned.records.mapPartitions(run), binned.rules
    if binned.tasks > 1 and (binned.tasks > rules.sums_left or binned.tasks * count * 8 > rules.driver_bytes):
        return parts.treeReduce(lambda a, b: narrowed(np.add(a, b, dtype=np.int64))).astype(np.int64)
    out = np.zeros(count, np.int64)
    for part in parts.collect():
        out += part
    return out


def _bin_counts(binned: Binned, folds: int) -> np.ndarray:
    """Training rows per (fold, label, feature, bin)."""
    features = binned.features
    shape = (folds, 2, features, 256)

    def of_block(block: Block) -> np.ndarray:
        fit = np.flatnonzero(block.fold >= 0)
        group = block.fold[fit].astype(np.int64) * 2 + block.label[fit]
        cell = ((group[:, None] * features + np.arange(features)) * 256 + block.bins[fit]).ravel()
        return np.bincount(cell, minlength=int(np.prod(shape)))

    return summed(binned, int(np.prod(shape)), of_block).reshape(shape)


@dataclass
class Slot:
    """A tree being grown for one model: its open nodes and the features each may split on."""

    model: int
    number: int
    feature: np.ndarray
    cut: np.ndarray
    open: list[int] = field(default_factory=lambda: [0])
    choice: np.ndarray | None = None  # open nodes x features tried
    rows: dict[int, float] = field(default_factory=dict)  # how much lies in each open node
    known: dict[int, np.ndarray] = field(default_factory=dict)  # sums of parents

    def counted(self) -> list[int]:
        """Open nodes to add up: of two siblings the lighter, where the parent's sums are known."""
        other = lambda n: n + 1 if n % 2 else n - 1
        return [n for n in self.open if (n - 1) // 2 not in self.known or (self.rows[n], n) < (self.rows[other(n)], other(n))]


def _level(
    binned: Binned, slots: list[Slot], level: int, bins: int, statistics: Callable[[Block, list[np.ndarray]], Callable[[Slot], tuple]]
) -> list[np.ndarray]:
    """Per slot: sums of two statistics per (open node, tried feature, bin).

    ``statistics`` prepares a block and gives, for a slot, its rows and lists of (which statistic, values).
    Where a node tries its parent's features, one of two siblings is the parent's sums less the other's.
    """
    taken = [s.counted() for s in slots]
    tries = [np.stack([s.choice[s.open.index(n)] for n in own]).astype(np.int16) for s, own in zip(slots, taken)]
    shapes = [(len(s.counted()), s.choice.shape[1], bins, 2) for s in slots]
    ends = np.cumsum([int(np.prod(s)) for s in shapes])
    nodes, default, features = len(slots[0].feature), binned.default, binned.features
    lean = [Slot(s.model, s.number, np.maximum(s.feature, 0), s.cut) for s in slots]  # what the tasks get

    def of_block(block: Block) -> np.ndarray:
        filled = [block.filled(own) for own in default]
        of_slot, out = statistics(block, filled), np.zeros(ends[-1])
        for slot, nodes_, choice, shape, end in zip(lean, taken, tries, shapes, ends):
            flat, size, tried = filled[slot.model].ravel(), int(np.prod(shape)), shape[1]
            place = np.full(nodes, -1)
            place[nodes_] = np.arange(len(nodes_))
            rows, parts = of_slot(slot)
            base = rows * features
            at = place.take(descended(flat, base, slot.feature.astype(np.intp), slot.cut, level))
            inside = np.flatnonzero(at >= 0)
            if len(inside) < len(at):
                at, base, parts = at[inside], base[inside], [tuple(x[inside] for x in part) for part in parts]
            first = np.arange(len(nodes_) * tried).reshape(-1, tried) * (2 * bins)
            cell = flat.take(choice.astype(np.intp).take(at, axis=0) + base[:, None]).astype(np.intp)
            cell += cell
            cell += first.take(at, axis=0)
            view = out[end - size : end]
            for which, value in parts:
                view += np.bincount((cell + which[:, None]).ravel(), np.repeat(value, tried), minlength=size)
        return out

    total = summed(binned, int(ends[-1]), of_block)
    parts = [total[end - int(np.prod(shape)) : end].reshape(shape) for shape, end in zip(shapes, ends)]
    return [_with_siblings(slot, own, sums) for slot, own, sums in zip(slots, taken, parts)]


def _with_siblings(slot: Slot, counted: list[int], sums: np.ndarray) -> np.ndarray:
    """The sums of all open nodes, from those of the nodes that were added up."""
    known = dict(zip(counted, sums))
    for n in set(slot.open) - set(counted):
        known[n] = slot.known[(n - 1) // 2] - known[n + 1 if n % 2 else n - 1]
    return np.stack([known[n] for n in slot.open])


@dataclass
class Forest:
    """How a forest's trees split: square root of the features tried a node, classes balanced."""

    features: int
    balance: np.ndarray  # models x 2: weights of the classes
    seed: int
    shared: ClassVar[bool] = False

    @property
    def tries(self) -> int:
        return max(1, int(np.sqrt(self.features)))

    def tried(self, slot: Slot, node: int) -> np.ndarray:
        rng = np.random.default_rng([self.seed, slot.model, slot.number, node])
        return np.sort(rng.permutation(self.features)[: self.tries])

    def quality(self, sums: np.ndarray, slot: Slot) -> np.ndarray:
        weighted = sums * self.balance[slot.model]
        rows = weighted.sum(axis=-1)
        return np.where(rows > 0, (weighted**2).sum(axis=-1) / np.maximum(rows, 1e-300), -np.inf)

    def value(self, sums: np.ndarray, slot: Slot) -> np.ndarray:
        weighted = sums * self.balance[slot.model]
        return weighted[..., 1] / np.maximum(weighted.sum(axis=-1), 1e-300)


@dataclass
class Boosting:
    """How boosted trees split. All nodes of a tree try the same features, and the second statistic tells how much lies in them."""

    features: int
    step: float
    sample: float
    positive_weight: float
    seed: int
    penalty: float
    least: float
    shared: ClassVar[bool] = True

    def tried(self, slot: Slot, node: int) -> np.ndarray:
        rng = np.random.default_rng([self.seed, slot.model, slot.number])
        return np.sort(rng.permutation(self.features)[: max(1, round(self.sample * self.features))])

    def statistics(self, margin: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slope and curvature of the loss, in whole parts."""
        p = 1.0 / (1.0 + np.exp(-margin))
        weight = np.where(label == 1, self.positive_weight, 1.0)
        slope, bend = weight * (p - label), weight * np.maximum(p * (1 - p), 1e-16)
        return np.rint(slope * UNIT), np.rint(bend * UNIT)

    def quality(self, sums: np.ndarray, slot: Slot) -> np.ndarray:
        slope, bend = sums[..., 0] / UNIT, sums[..., 1] / UNIT
        return np.where(bend >= self.least, slope**2 / (bend + self.penalty), -np.inf)

    def value(self, sums: np.ndarray, slot: Slot) -> np.ndarray:
        return -self.step * (sums[..., 0] / UNIT) / (sums[..., 1] / UNIT + self.penalty)


def _grow(
    bins: int, slots: list[Slot], trees: list[Trees], depth: int, rule: Forest | Boosting, sums_of: Callable[[list[Slot], int], list[np.ndarray]]
) -> None:
    """Grow one tree per slot, level by level; ``rule.quality`` of child sums is -inf where a child is not allowed.

    ``sums_of`` gives, per slot that still grows, the sums of two statistics per (open node, tried feature, bin) of a level.
    """
    for level in range(depth):
        growing = [(s, t) for s, t in zip(slots, trees) if s.open]
        if not growing:
            return
        for slot, _ in growing:
            slot.choice = np.stack([rule.tried(slot, node) for node in slot.open])
        sums = sums_of([s for s, _ in growing], level)
        for (slot, tree), own in zip(growing, sums):
            left = own.cumsum(axis=2)
            total = left[:, 0, -1]
            right = total[:, None, None] - left
            gain = rule.quality(left, slot) + rule.quality(right, slot) - rule.quality(total, slot)[:, None, None]
            gain = np.where(np.isfinite(gain), gain, -np.inf).reshape(len(own), -1)
            best = gain.argmax(axis=1)
            chosen, cut = np.divmod(best, bins)
            each = np.arange(len(own))
            if level == 0:
                tree.value[slot.number, 0] = rule.value(total, slot)[0]
            good = gain[each, best] > MIN_GAIN * (1 + np.abs(rule.quality(total, slot)))
            halves = left[each, chosen, cut], right[each, chosen, cut]
            sides = [rule.value(h, slot) for h in halves]
            following, slot.rows, slot.known = [], {}, {}
            for k in np.flatnonzero(good):
                node = slot.open[k]
                tree.feature[slot.number, node] = slot.choice[k, chosen[k]]
                tree.cut[slot.number, node] = cut[k]
                tree.gain[slot.number, node] = gain[k, best[k]]
                for child, side, half in zip((2 * node + 1, 2 * node + 2), sides, halves):
                    tree.value[slot.number, child] = side[k]
                    slot.rows[child] = float(half[k].sum() if not rule.shared else half[k, 1])
                    following.append(child)
                if rule.shared:
                    slot.known[node] = own[k]
            slot.open = following


def grow_forest(binned: Binned, count: int, depth: int, seed: int) -> list[Trees]:
    """Per model ``count`` trees on bootstrap draws, classes balanced, square root of the features tried a node."""
    balance = binned.counts.sum(axis=1, keepdims=True) / np.maximum(2 * binned.counts, 1)
    rule, bins = Forest(binned.features, balance, seed), binned.most_bins
    forests = [Trees.empty(count, depth) for _ in range(binned.models)]
    if binned.in_one_task:
        context = binned.records.blocks.context
        ranges = max(1, min(count, -(-binned.rules.whole_tasks * context.defaultParallelism // binned.models)))
        starts = [count * k // ranges for k in range(ranges)]
        work = [(m, a, b) for m in range(binned.models) for a, b in zip(starts, [*starts[1:], count])]
        for (m, a, b), grown in zip(work, _grown_whole(binned, work, depth, rule), strict=True):
            for name in ("feature", "cut", "value", "gain"):
                getattr(forests[m], name)[a:b] = getattr(grown, name)
        return forests
    held = [binned.held_fold(m) for m in range(binned.models)]

    def statistics(block: Block, filled: list[np.ndarray]) -> Callable[[Slot], tuple]:
        of_model = {}  # rows, what the hashes of their trees start from, labels

        def of_slot(slot: Slot) -> tuple:
            if slot.model not in of_model:
                rows = np.flatnonzero((block.fold >= 0) & (block.fold != held[slot.model]))
                of_model[slot.model] = rows, stirred(stirred(block.uid[rows], seed), slot.model), block.label[rows]
            rows, state, label = of_model[slot.model]
            times = times_drawn(uniform(stirred(state, slot.number)))
            some = np.flatnonzero(times)
            return rows[some], [(label[some], times[some].astype(np.float64))]

        return of_slot

    level_bytes = 16 * binned.models * 2 ** max(0, depth - 1) * rule.tries * bins
    together = max(1, binned.rules.histogram_bytes // level_bytes)
    for a in range(0, count, together):
        slots, trees = [], []
        for m in range(binned.models):
            for t in range(a, min(count, a + together)):
                slots.append(Slot(m, t, forests[m].feature[t], forests[m].cut[t]))
                trees.append(forests[m])
        _grow(bins, slots, trees, depth, rule, lambda growing, level: _level(binned, growing, level, bins, statistics))
    return forests


def grow_boosted(
    binned: Binned, rounds: int, depth: int, step: float, sample: float, positive_weight: float, seed: int,
    penalty: float = 1.0, least: float = 1.0,
) -> tuple[list[Trees], Binned]:
    """Per model ``rounds`` trees by second-order boosting of the logistic loss; also the blocks with final scores.

    Each tree sees a share ``sample`` of the rows and of the features. ``penalty`` is added to a leaf's curvature,
    which must be at least ``least`` on either side of a split.
    """
    rule, bins = Boosting(binned.features, step, sample, positive_weight, seed, penalty, least), binned.most_bins
    if binned.in_one_task:
        models = _grown_whole(binned, [(m, 0, rounds) for m in range(binned.models)], depth, rule)
        return models, _with_margins(binned, models, depth)
    models = [Trees.empty(rounds, depth) for _ in range(binned.models)]
    held = [binned.held_fold(m) for m in range(binned.models)]
    waiting: list[int] = []  # rounds not yet in the stored scores

    def chosen(m: int, rounds_: list[int]) -> Trees:
        return Trees(models[m].feature[rounds_], models[m].cut[rounds_], models[m].value[rounds_], models[m].gain[:0])

    for r in range(rounds):
        pending = [chosen(m, waiting) for m in range(binned.models)]  # what the stored scores lack

        def statistics(block: Block, filled: list[np.ndarray]) -> Callable[[Slot], tuple]:
            def of_slot(slot: Slot) -> tuple:
                m = slot.model
                used = (block.fold >= 0) & (block.fold != held[m]) & (drawn(block.uid, seed, m, slot.number) < sample)
                rows = np.flatnonzero(used)
                slope, bend = rule.statistics(added(block.margin[m][rows], pending[m], filled[m][rows], depth), block.label[rows])
                first = np.zeros(len(rows), np.uint8)
                return rows, [(first, slope), (first + 1, bend)]

            return of_slot

        slots = [Slot(m, r, models[m].feature[r], models[m].cut[r]) for m in range(binned.models)]
        _grow(bins, slots, models, depth, rule, lambda growing, level: _level(binned, growing, level, bins, statistics))
        waiting.append(r)
        if len(waiting) == binned.rules.written_every or r == rounds - 1:
            before, binned = binned, _with_margins(binned, [chosen(m, waiting) for m in range(binned.models)], depth)
            if r >= binned.rules.written_every:
                before.blocks.unpersist()  # the first blocks belong to the caller
            waiting = []
    return models, binned


class Whole:
    """All rows that a model is fitted on, held by one task. Positions in a tree are carried from level to level."""

    def __init__(self, records: Iterator, features: int, default: np.ndarray, held: int, rules: TreeRules):
        parts: list[tuple] = []
        for record in records:
            fold = np.frombuffer(record["fold"], np.int8)
            fit = np.flatnonzero((fold >= 0) & (fold != held))
            own = np.frombuffer(record["bins"], np.uint8).reshape(-1, features)[fit]
            uid, label = np.frombuffer(record["uid"], "<u8"), np.frombuffer(record["label"], np.uint8)
            parts.append((uid[fit], label[fit], np.where(own == MISSING, default, own).astype(np.uint8)))
        none = np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.zeros((0, features), np.uint8)
        self.uid, self.label, bins = (np.concatenate(x) for x in zip(*(parts or [none])))
        self.features, self.flat, self.rules = features, bins.ravel(), rules

    def chunks(self, rows: np.ndarray) -> Iterator[slice]:
        return (slice(a, a + self.rules.chunk_rows) for a in range(0, len(rows), self.rules.chunk_rows))

    def descend(self, slot: Slot, at: np.ndarray, rows: np.ndarray) -> None:
        """Carry the positions of ``rows`` one level down; below a leaf, to some node that was never open."""
        feature = np.maximum(slot.feature, 0).astype(np.intp)
        for part in self.chunks(rows):
            node = at[part]
            right = self.flat.take(rows[part] * self.features + feature.take(node)) > slot.cut.take(node)
            node += node
            node += 1
            node += right

    def forest(self, trees: Trees, numbers: range, model: int, depth: int, bins: int, rule: Forest) -> None:
        state = stirred(stirred(self.uid, rule.seed), model)
        for t in numbers:
            times = times_drawn(uniform(stirred(state, t)))
            rows = np.flatnonzero(times)
            times, label, at = times[rows].astype(np.float64), self.label[rows].astype(np.intp), np.zeros(len(rows), np.intp)

            def sums(growing: list[Slot], level: int) -> list[np.ndarray]:
                slot = growing[0]
                if level:
                    self.descend(slot, at, rows)
                place, nodes = np.full(trees.feature.shape[1], -1), len(slot.open)
                place[slot.open] = np.arange(nodes)
                out = np.zeros((rule.tries, nodes * 2 * bins))
                for part in self.chunks(rows):
                    own = place.take(at[part])
                    inside = np.flatnonzero(own >= 0)
                    own, base, weight = own[inside], rows[part][inside] * self.features, times[part][inside]
                    first = (own * 2 + label[part][inside]) * bins
                    for k, feature in enumerate(slot.choice.T):
                        cell = first + self.flat.take(base + feature.take(own))
                        out[k] += np.bincount(cell, weight, out.shape[1])
                return [np.ascontiguousarray(out.reshape(-1, nodes, 2, bins).transpose(1, 0, 3, 2)).astype(np.int64)]

            _grow(bins, [Slot(model, t, trees.feature[t], trees.cut[t])], [trees], depth, rule, sums)

    def boosted(self, trees: Trees, model: int, depth: int, bins: int, rule: Boosting) -> None:
        columns = np.ascontiguousarray(self.flat.reshape(-1, self.features).T)
        everyone, margin, state = np.arange(len(self.uid)), np.zeros(len(self.uid)), stirred(stirred(self.uid, rule.seed), model)
        for r in range(len(trees.feature)):
            rows = np.flatnonzero(uniform(stirred(state, r)) < rule.sample)
            slope, bend = rule.statistics(margin[rows], self.label[rows])
            at, reached = np.zeros(len(everyone), np.intp), 0
            slot = Slot(model, r, trees.feature[r], trees.cut[r])

            def sums(growing: list[Slot], level: int) -> list[np.ndarray]:
                nonlocal reached
                if level:
                    self.descend(slot, at, everyone)
                    reached = level
                counted = slot.counted()
                place, nodes, tried = np.full(trees.feature.shape[1], -1), len(counted), slot.choice[0]
                place[counted] = np.arange(nodes) * bins
                out = np.zeros((2, len(tried), nodes * bins))
                for part in self.chunks(rows):
                    own = rows[part]
                    first = place.take(at.take(own))
                    inside = np.flatnonzero(first >= 0)
                    own, first, g, h = own[inside], first[inside], slope[part][inside], bend[part][inside]
                    for k, feature in enumerate(tried):
                        cell = first + columns[feature].take(own)
                        out[0, k] += np.bincount(cell, g, out.shape[2])
                        out[1, k] += np.bincount(cell, h, out.shape[2])
                found = np.ascontiguousarray(out.reshape(2, -1, nodes, bins).transpose(2, 1, 3, 0)).astype(np.int64)
                return [_with_siblings(slot, counted, found)]

            _grow(bins, [slot], [trees], depth, rule, sums)
            for _ in range(reached, depth):
                self.descend(slot, at, everyone)
            bottom = bottom_values(Trees(trees.feature[r : r + 1], trees.cut, trees.value[r : r + 1], trees.gain), depth)
            margin += bottom[0].take(at - (2**depth - 1))


def _grown_whole(binned: Binned, work: list[tuple[int, int, int]], depth: int, rule: Forest | Boosting) -> list[Trees]:
    """One task for each (model, first tree, end), which reads all blocks; its trees, in this order."""
    features, default, rules, bins = binned.features, binned.default, binned.rules, binned.most_bins
    held = [binned.held_fold(m) for m in range(binned.models)]

    def run(task: int, records: Iterator) -> Iterator[tuple]:
        model, first, end = work[task]
        whole, trees = Whole(records, features, default[model], held[model], rules), Trees.empty(end, depth)
        if rule.shared:
            whole.boosted(trees, model, depth, bins, rule)
        else:
            whole.forest(trees, range(first, end), model, depth, bins, rule)
        yield task, [a[first:end] for a in (trees.feature, trees.cut, trees.value, trees.gain)]

    blocks = binned.stored.select("uid", "label", "fold", "bins").rdd.coalesce(1)
    tasks = blocks.context.union([blocks] * len(work)) if len(work) > 1 else blocks
    return [Trees(*arrays) for _, arrays in sorted(tasks.mapPartitionsWithIndex(run).collect(), key=lambda x: x[0])]


def _with_margins(binned: Binned, grown: list[Trees], depth: int) -> Binned:
    """The blocks with the given trees of each model added to their scores, stored."""
    features, models, default = binned.features, binned.models, binned.default

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = []
            for record in batch.drop_columns(["keys"]).to_pylist():
                block = Block(record, features, models)
                own = [added(block.margin[m], grown[m], block.filled(default[m]), depth) for m in range(models)]
                new.append(np.stack(own).astype("<f8").tobytes())
            at = batch.schema.get_field_index("margin")
            yield batch.set_column(at, "margin", pa.array(new, pa.binary()))

    stored = settle(binned.blocks.mapInArrow(run, binned.blocks.schema), "tree-scores")
    return replace(binned, blocks=_kept(stored, binned.tasks), stored=stored)


def depth_of(trees: Trees) -> int:
    return int(np.log2(trees.feature.shape[1] + 1)) - 1


def forest_share(trees: Trees, bins: np.ndarray) -> np.ndarray:
    """Mean leaf share of class 1."""
    return added(np.zeros(len(bins)), trees, bins, depth_of(trees)) / max(1, len(trees.feature))


def boosted_share(trees: Trees, bins: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-added(np.zeros(len(bins)), trees, bins, depth_of(trees))))


def scored_rows(binned: Binned, key: str, forests: list[Trees] | None, boosted: bool) -> DataFrame:
    """Per row: key, label, fold, and p by each model as arrays ``forest`` and ``boosting`` (null if not fitted)."""
    features, models, default = binned.features, binned.models, binned.default
    kind = binned.blocks.schema["keys"].dataType.elementType.simpleString()
    width = pa.list_(pa.float64())

    def lists(p: np.ndarray | None, n: int) -> pa.Array:
        if p is None:
            return pa.nulls(n, width)
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * models), pa.array(p.T.ravel()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, record in enumerate(batch.drop_columns(["keys"]).to_pylist()):
                block = Block(record, features, models)
                n, keys = len(block.label), batch.column("keys").slice(k, 1).flatten()
                forest = boosting = None
                if forests is not None:
                    forest = np.stack([forest_share(forests[m], block.filled(default[m])) for m in range(models)])
                if boosted:
                    boosting = 1.0 / (1.0 + np.exp(-block.margin))
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(block.label.astype(np.float64)), pa.array(block.fold.astype(np.int32)), lists(forest, n), lists(boosting, n)],
                    names=[key, "label", "fold", "forest", "boosting"],
                )

    schema = f"`{key}` {kind}, label double, fold int, forest array<double>, boosting array<double>"
    return binned.blocks.mapInArrow(run, schema)


# ---- a fitted model -------------------------------------------------------------------------------------------


@dataclass
class TreeModel:
    """A forest or boosted trees over the prepared vector; bin edges are in the vector's units."""

    kind: str  # "forest" or "boosting"
    trees: Trees
    edges: list[np.ndarray]

    @property
    def importances(self) -> list[float]:
        return self.trees.importance(len(self.edges), self.kind == "forest").tolist()

    def probabilities(self, prepared: DataFrame, vector: str, name: str = "p") -> DataFrame:
        """Adds the probability of class 1 of each prepared vector."""
        share, trees, edges = forest_share if self.kind == "forest" else boosted_share, self.trees, self.edges

        @F.arrow_udf("double")
        def p(x: pa.Array) -> pa.Array:
            values = x.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(x), len(edges))
            return pa.array(share(trees, bin_places(values, edges)))

        return prepared.withColumn(name, p(vector_to_array(vector)))

    def save(self, spark: SparkSession, folder: str) -> None:
        """One row per tree, and one with the bin edges."""
        t = self.trees
        rows = [
            (k, self.kind, *(a[k].tolist() for a in (t.feature.astype(int), t.cut.astype(int), t.value, t.gain)), None)
            for k in range(len(t.feature))
        ]
        rows.append((-1, self.kind, None, None, None, None, [e.tolist() for e in self.edges]))
        schema = "tree int, kind string, feature array<int>, cut array<int>, value array<double>, gain array<double>, edges array<array<double>>"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(folder)

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> TreeModel:
        rows = spark.read.parquet(folder).orderBy("tree").collect()
        column = lambda name, kind: np.array([r[name] for r in rows[1:]], dtype=kind)
        trees = Trees(column("feature", np.int16), column("cut", np.uint8), column("value", float), column("gain", float))
        return cls(rows[0]["kind"], trees, [np.array(e, dtype=np.float64) for e in rows[0]["edges"]])
