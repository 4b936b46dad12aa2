import collections

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from conftest import SMALL, crc, lower, words

import corpus_pipeline
from tidemark.llm import suffix_tree as s
from tidemark.llm.common import flat, fold
from tidemark.llm.queries import QUERIES


def base_of(rows):
    """{id: (held_out, tokens, known, base)} by plain counting over (id, text) rows, and N."""
    count = collections.Counter()
    for own, text in rows:
        if crc(own, 5) != 1:
            count.update(words(lower(text)))
            count["\n"] += 1
    total, kinds = sum(count.values()), len(count)
    out = []
    for own, text in rows:
        tokens = [*words(lower(text)), "\n"]
        base = sum(np.log10((count[t] + 0.5) / (total + 0.5 * (kinds + 1))) for t in tokens)
        out.append((crc(own, 5) == 1, len(tokens), sum(count[t] > 0 for t in tokens), base))
    return out, total


@pytest.mark.parametrize("share", [1e-6, 1e-3, 0.5])
def test_base_counts(spark, documents, share):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r["doc_id"]: r for r in s.score_texts(df, fold("doc_id", 5) != 1, rules=s.TreeModelRules(word_share=share)).collect()}
    rows = list(zip(documents.doc_id, documents.text))
    expected, total = base_of(rows)
    for (own, _), (held, tokens, known, base) in zip(rows, expected):
        r = got[own]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, tokens, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)


def test_the_tree_beats_the_base_on_unseen_texts(spark):
    got = QUERIES["op4_suffix_tree"](spark, "/root/testdata/sf0.01").toPandas()
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_distributions_add_up_to_one():
    texts = ["abra cadabra abra", "banana bandana", "", "cab ab ab ab"] * 5
    symbols, limits, _, _ = s.symbol_stream(*flat(pa.array(texts)))
    rules = s.TreeModelRules(depth=3, state_share=0, entry_share=0, divergence=0.1)
    key, count = np.unique(s.windows(symbols, limits, 3), return_counts=True)
    key, count = map(np.concatenate, zip(*s.all_orders(key, count, 3)))
    tree = s.grow_tree(key, count, len(texts), rules)
    assert len(tree.contexts[3]) > 3
    for context in (0, 0x6272, 0x616E61, 0x7A7A7A, 0x20626120):
        every = np.sort(np.array([(c << 24) | (context & 0xFFFFFF) for c in range(256)], dtype=np.uint64))
        seen = 10 ** s.SuffixTree.scores(tree, every)
        assert 0.95 < seen.sum() <= 1 + 1e-9  # one more symbol is reserved


def test_windows_stop_at_text_starts():
    symbols, limits, _, _ = s.symbol_stream(*flat(pa.array(["A b", None, "c"])))
    assert symbols.tobytes() == b"a b \n\nc \n" and limits.tolist() == [0, 5, 6, 9]
    key = s.windows(symbols, limits, 2)
    assert [int(k) for k in key[[0, 1, 5, 6]]] == [0x610000, 0x206100, 0x0A0000, 0x630000]


def test_odd_rows(spark, odd, none):
    got = s.score_texts(odd, fold("doc_id", 5) != 1).collect()
    expected, _ = base_of([(r["doc_id"], r["text"]) for r in odd.collect()])
    brief = lambda rows: sorted((str(a), b, c, round(d, 6)) for a, b, c, d in rows)
    assert brief((r["held_out"], r["n_tokens"], r["n_known"], r["base_score"]) for r in got) == brief(expected)
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert s.score_texts(none, fold("doc_id", 5) != 1).count() == 0
    unlearned = s.score_texts(odd, fold("doc_id", 5) < 0).collect()
    assert {(r["train_tokens"], r["n_known"], r["base_score"]) for r in unlearned} == {(0, 0, 0.0)}


def test_pipeline_stages(spark):
    from tidemark.llm.quality import QualityRules, lengths_of, measure, verdicts
    from test_simhash_mixing import plain_classes, plain_print

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept, steps = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        kept = corpus_pipeline.store(stage(spark, kept, folder), f"test-{name}")
        steps[name] = kept.toPandas()
        if name != "encoding":
            assert kept.columns == docs.columns
    first = docs.toPandas()
    assert set(steps["language"].doc_id) == set(first[first.text.str.contains(r"[^\W\d_]")].doc_id)
    rules = QualityRules()
    good = verdicts(measure(*flat(pa.array(steps["language"].text)), lengths_of(rules)), rules)[1]
    assert set(steps["quality"].doc_id) == set(steps["language"].doc_id[good])
    own = steps["quality"].sort_values("doc_id").reset_index(drop=True)
    label = plain_classes([plain_print(t) for t in own.text])
    assert sorted(steps["near_copies"].doc_id) == sorted(own.doc_id[np.unique(label)])
    times = steps["mixing"].groupby("doc_id").size()
    assert times.max() <= 2 and set(times.index) <= set(steps["near_copies"].doc_id)
    assert pd.Series(steps["encoding"].doc_id).value_counts().to_dict() == times.to_dict()


def test_pipeline_odd_rows(spark, odd, none):
    for rows in (odd, none):
        kept = rows
        for name, stage in corpus_pipeline.STAGES:
            kept = corpus_pipeline.store(stage(spark, kept, SMALL), f"odd-{name}")
            assert name == "encoding" or kept.columns == rows.columns
        assert (kept.count() > 0) == (rows is odd)


@pytest.mark.parametrize("share", [0.0, 1e-3, 0.5])
def test_scores_equal_one_whole_tree(spark, share):
    texts = ["abra cadabra abra", "banana bandana", "", "cab ab ab ab", "abracadabra zebra", "\x00 nul \x00\x00"] * 4
    texts += [f"only {k * k} here" for k in range(30)]
    rows = list(enumerate(texts))
    learned = [t for own, t in rows if crc(own, 5) != 1]
    rules = s.TreeModelRules(gram_share=share, divergence=0.1)
    symbols, limits, _, _ = s.symbol_stream(*flat(pa.array(learned)))
    key, count = np.unique(s.windows(symbols, limits, rules.depth), return_counts=True)
    tree = s.grow_tree(*map(np.concatenate, zip(*s.all_orders(key, count, rules.depth))), len(learned), rules)
    got = s.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), fold("doc_id", 5) != 1, rules=rules)
    got = {r["doc_id"]: r["score"] for r in got.collect()}
    for own, text in rows:
        symbols, limits, _, _ = s.symbol_stream(*flat(pa.array([text])))
        assert got[own] == pytest.approx(tree.scores(s.windows(symbols, limits, rules.depth)).sum(), rel=1e-9)


def test_what_is_seen_three_times_counts_in_a_large_corpus(spark):
    few = [(k, "quixotic jazz") for k in range(3)]
    many = [(10 + k, "aa bb " * 350_000) for k in range(10)]
    schema, learn = "doc_id long, text string", fold("doc_id", 1) == 0
    score = {}
    for name, rows in (("small", few), ("large", few + many)):
        df = spark.createDataFrame(rows, schema)
        score[name] = s.score_texts(df, learn).filter("doc_id = 0").first()["score"]
    # the first symbols are rarer in the large corpus, the others follow from their contexts as before
    assert score["large"] > score["small"] - 14
