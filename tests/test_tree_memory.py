import time
from types import SimpleNamespace

import numpy as np

from tidemark import session
from tidemark.ml import training, trees


class Records:
    """Blocks dealt to tasks; notes the bytes that each pass brings to the driver."""

    def __init__(self, tasks):
        self.tasks, self.brought = tasks, []

    def mapPartitions(self, f):
        def parts():
            return [total for own in self.tasks for total in f(iter(own))]

        def collect():
            out = parts()
            self.brought.append(sum(p.nbytes for p in out))
            return out

        def tree_reduce(add):
            first, *rest = parts()
            for part in rest:
                first = add(first, part)
            self.brought.append(first.nbytes)
            return first

        return SimpleNamespace(collect=collect, treeReduce=tree_reduce)


def table(tasks, rows=300, features=16, folds=2):
    rng = np.random.default_rng(7)
    places = [
        [{"uid": rng.integers(0, 2**62, rows).astype("<u8").tobytes(), "label": rng.integers(0, 2, rows).astype(np.uint8).tobytes(),
          "fold": rng.integers(0, folds, rows).astype(np.int8).tobytes(), "bins": rng.integers(0, 64, (rows, features)).astype(np.uint8).tobytes(),
          "margin": np.zeros((folds + 1, rows), "<f8").tobytes()}]
        for _ in range(tasks)
    ]
    binned = object.__new__(trees.Binned)
    binned.edges, binned.models, binned.tasks, binned.rules = [np.arange(63.0)] * features, folds + 1, tasks, trees.TreeRules()
    binned.default, binned.records = np.zeros((folds + 1, features), np.uint8), Records(places)
    binned.counts = trees._bin_counts(binned, folds)[:, :, 0].sum(axis=(0, 2))[None].repeat(folds + 1, 0).astype(float)
    return binned


def test_the_sums_of_a_pass_that_reach_the_driver_are_bounded():
    binned = table(tasks=6)
    trees.grow_forest(binned, 60, 6, 42)
    assert max(binned.records.brought) <= trees.TreeRules().driver_bytes


def test_narrow_partial_sums_add_up_exactly():
    for big in (0, 100, 127, 128, -129, 40_000, 2**31, -(2**31) - 1, 2**62):
        total = np.array([1, -1, big], np.int64)
        assert np.array_equal(trees.narrowed(total).astype(np.int64), total)
    assert trees.narrowed(np.array([3, 127])).nbytes == 2
    one, two = table(tasks=2), table(tasks=2)
    two.rules = trees.TreeRules(driver_bytes=0)  # added up in tasks
    a, b = trees.grow_forest(one, 3, 3, 1), trees.grow_forest(two, 3, 3, 1)
    assert all(np.array_equal(x.value, y.value) and np.array_equal(x.cut, y.cut) for x, y in zip(a, b))


class Brought:
    """A stored block table's records that notes what each pass brings to the driver."""

    def __init__(self, rdd, seen):
        self.rdd, self.seen, self.context = rdd, seen, rdd.context

    def collect(self):
        out = self.rdd.collect()
        self.seen.append([piece.nbytes for _, piece in out])
        return out

    def __getattr__(self, name):
        def call(*args):
            return Brought(getattr(self.rdd, name)(*args), self.seen)

        return call


def test_every_sum_reaches_the_driver_once_and_in_short_pieces(spark):
    blocks = [np.full(20_000, k, np.int64) for k in (1, 300, 70_000, 5, 2**40)]
    rules = trees.TreeRules()
    for tasks in (5, 1):
        seen = []
        arrays = spark.sparkContext.parallelize(blocks, 5)
        parts = trees.Records(Brought(arrays, seen), tasks, rules).mapPartitions(lambda own: own)
        add = lambda a, b: trees.narrowed(np.add(a, b, dtype=np.int64))
        total = parts.treeReduce(add)
        assert np.array_equal(total, sum(blocks)) and len(seen[0]) == 3 and max(seen[0]) <= 8 * rules.piece_cells
        assert all(np.array_equal(a, b) for a, b in zip(parts.collect(), blocks, strict=True))
        assert len(seen[1]) == 15 and max(seen[1]) <= 8 * rules.piece_cells


def test_garbage_of_finished_passes_is_collected_on_the_way(spark, monkeypatch):
    collected = []
    monkeypatch.setattr(trees, "drop_unused", collected.append)
    records = trees.Records(spark.sparkContext.parallelize([1], 1), 1, trees.TreeRules(passes_kept=2))
    for _ in range(5):
        records.mapPartitions(lambda own: (np.array([x]) for x in own))
    assert len(collected) == 2


def test_rows_that_end_in_an_early_leaf_keep_its_value():
    grown = trees.Trees.empty(1, 3)
    grown.feature[0, 0], grown.cut[0, 0], grown.value[0, :3] = 1, 4, (9.0, 2.0, 3.0)  # both children are leaves
    bins = np.array([[9, 4], [0, 5], [7, 255]], np.uint8)
    assert trees.added(np.ones(3), grown, bins, 3).tolist() == [3.0, 4.0, 4.0]
    assert trees.added(np.zeros(3), trees.Trees.empty(2, 3), bins, 3).tolist() == [0.0] * 3
    u = np.concatenate([trees.POISSON, np.linspace(0, 0.999, 50)])
    assert np.array_equal(trees.times_drawn(u), np.searchsorted(trees.POISSON, u, "right"))


def test_garbage_is_collected_as_soon_as_the_drivers_heap_has_filled_up(spark, monkeypatch):
    heap, collected = [200], []
    monkeypatch.setattr(trees, "heap_used", lambda context: (heap[0], 1000))
    monkeypatch.setattr(trees, "drop_unused", lambda context: collected.append(heap[0]) or heap.__setitem__(0, 210))
    records = trees.Records(spark.sparkContext.parallelize([1], 1), 1, trees.TreeRules(passes_kept=100, heap_growth=0.12))
    for used in (250, 320, 300, 100, 219, 221, 330):  # at a pass; 100: the JVM has collected by itself
        heap[0] = used
        records.mapPartitions(lambda own: own)
    assert collected == [221]


def test_linear_folds_beside_the_trees_run_one_by_one(spark, monkeypatch):
    running, most = [0], {}

    def fitted(preparation, rest, settings):
        running[0] += 1
        most["now"] = max(most.get("now", 0), running[0])
        time.sleep(0.2)
        running[0] -= 1

    monkeypatch.setattr(training, "_fit_preparation", lambda rest, settings: None)
    monkeypatch.setattr(training, "_fit_logistic", fitted)
    monkeypatch.setattr(training, "_labelled_vectors", lambda preparation, held: held)
    monkeypatch.setattr(training, "_auc", lambda model, held: held)
    folded = SimpleNamespace(where=lambda condition: 0.5)
    for at_once, expected in ((1, 1), (None, 5)):
        most.clear()
        assert training.linear_fold_auc(folded, training.Settings(), at_once) == [0.5] * 5
        assert most["now"] == expected


def test_native_memory_is_handed_back_with_the_garbage(spark, monkeypatch):
    context, given = spark.sparkContext, []
    assert session.hand_back(context) in (True, False)  # by what the JVM knows
    monkeypatch.setattr(session, "TRIM", "noSuchCommand")
    assert session.hand_back(context) is False
    monkeypatch.setattr(session, "hand_back", given.append)
    session.drop_unused(context)
    assert given == [context]
