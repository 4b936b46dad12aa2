import re

import numpy as np
import pytest
import xxhash
from compare import connect, difference
from conftest import SMALL

from tidemark.llm import mixing, simhash
from tidemark.llm.components import components
from tidemark.llm.queries import QUERIES, all_checks


def plain_print(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)][: len(w)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints, distance=3):
    prints = np.array(prints, dtype=np.uint64)
    label = np.arange(len(prints))
    while True:
        before = label.copy()
        for i in range(len(prints)):
            near = np.bitwise_count(prints ^ prints[i]) <= distance
            label[near] = label[near].min()
        if np.array_equal(before, label):
            return label


def test_query_equals_brute_force(spark, documents):
    docs = documents.sort_values("doc_id").reset_index(drop=True)
    got = QUERIES["op7_simhash"](spark, SMALL).toPandas().sort_values("doc_id").reset_index(drop=True)
    prints = [plain_print(t) for t in docs.text]
    assert got.fingerprint.tolist() == [f"{p:016x}" for p in prints]
    assert got.component_id.tolist() == docs.doc_id.values[plain_classes(prints)].tolist()


def test_odd_rows(spark, odd, none):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    zero = [r for r in got if r["doc_id"] in (1, 2, 3)]
    assert {(r["fingerprint"], r["component_id"]) for r in zero} == {("0" * 16, 1)}
    assert {r["component_id"] for r in got if r["doc_id"] in (6, 7)} == {6}
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one_of_each(none).count() == 0
    kept = simhash.keep_one_of_each(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len({r["class"] for r in got}) and 7 not in ids and ids.count(1) == 1


def test_repeated_rows_leave_one(spark):
    df = spark.createDataFrame([(5, "same text in both rows of this id")] * 4 + [(9, "another text, quite different from it")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.keep_one_of_each(df).collect()) == [5, 9]


@pytest.mark.parametrize("block,small", [(8192, 16), (40, 2), (7, 16)])
def test_links_lose_nothing_in_dense_and_split_groups(spark, block, small):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    own = {int(c) for c in rng.integers(0, 1 << 63, 150, dtype=np.uint64)}
    for c in centres:  # dense balls: each value a few flips from its centre
        for _ in range(60):
            own.add(int(c) ^ sum({1 << int(b) for b in rng.integers(0, 60, rng.integers(0, 5))}))
    own = sorted(own)
    nodes = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in own], "fingerprint long").repartition(4)
    rules = simhash.SimHashRules(block=block, small=small)
    root = {r["u"]: r["root"] for r in components(simhash.fingerprint_links(nodes, rules)).collect()}
    signed = [int(np.uint64(v).view(np.int64)) for v in own]
    label = plain_classes(own)
    names = {}
    for v, k in zip(signed, label):
        names.setdefault(k, set()).add(root.get(v, v))
    assert all(len(n) == 1 for n in names.values()) and len({n for s in names.values() for n in s}) == len(names)


def test_thresholds_satisfy_the_principle():
    rng = np.random.default_rng(1)
    for m in (2, 3, 4):
        costs = [[0.0, *np.sort(rng.random(4))] for _ in range(m)]
        cost, chosen = simhash.allot(costs, 3 - m + 1)
        assert sum(chosen) == 3 - m + 1 and len(chosen) == m
        assert cost == pytest.approx(sum(c[t + 1] for c, t in zip(costs, chosen)))


def test_bit_groups_are_a_partition():
    together = np.random.default_rng(2).random((64, 64)) * 100
    for m in (2, 3, 4):
        groups = simhash.correlated_groups(1000, together + together.T, m)
        assert sorted(b for g in groups for b in g) == list(range(64))


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    root = {r["u"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert root == {k: 0 for k in range(1, 41)} | {k: 100 for k in range(101, 140)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("name", ["op3_mixing", "op8_top_products"])
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SMALL), connect(SMALL), all_checks()[name]) is None


def test_mix_odd_rows(spark, odd, none):
    got = mixing.mix_report(odd).collect()
    assert len(got) == odd.count()
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert sum(r["source"] is None for r in got) == sum(r["source"] is None for r in odd.collect())
    assert mixing.mix_report(none).count() == 0 and mixing.mix_documents(none).count() == 0
    mixed = mixing.mix_documents(odd)
    assert mixed.columns == odd.columns
    assert sum(len((r["text"] or "").split()) for r in mixed.collect()) > 0


def test_mix_meets_targets_with_a_hot_source(spark):
    df = spark.range(6000).selectExpr(
        "id AS doc_id", "repeat('w ', 5 + CAST(id % 40 AS INT)) AS text", "concat('s', if(id % 3 = 0, 0, id % 7)) AS source"
    )
    rules = mixing.MixRules(slice_rows=64)
    got = mixing.mix_report(df, rules=rules).groupBy("source").agg({"taken": "sum", "target": "max", "source_size": "max"})
    for r in got.collect():
        assert abs(r["sum(taken)"] - r["max(target)"]) <= 45
        assert r["max(target)"] <= 2 * r["max(source_size)"]
    rows = mixing.mix_documents(df, rules=rules).groupBy("doc_id").count().collect()
    assert max(r["count"] for r in rows) == 2
