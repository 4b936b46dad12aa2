import collections
import re

import numpy as np
import pyarrow as pa
from conftest import SMALL  # noqa: F401  (tests/llm/conftest.py)
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import quality as q
from tidemark.llm.common import Words, flat, text_slices
from tidemark.llm.langid import LangRules, has_letter, keep_identified, predict_languages, train_language_model
from tidemark.llm.queries import QUERIES


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(5)}
    seen, again = set(), 0
    for line in text.split("\n"):
        again += line in seen and bool(re.search(r"[^\x20\x09-\x0D]", line))
        seen.add(line)
    base = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered), base


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_counts_on_documents(spark, documents):
    got = {r["doc_id"]: r for r in QUERIES["op1_quality"](spark, SMALL).collect()}
    assert len(got) == len(documents)
    for row in documents.itertuples():
        assert tuple(got[row.doc_id][c] for c in BASE) == plain(row.text)
        assert not (got[row.doc_id]["base_failed"] and got[row.doc_id]["kept"])


def test_odd_rows(spark, odd, none):
    assert q.quality_report(none).count() == 0 and q.keep_good(none).columns == none.columns
    got = sorted(tuple(map(repr, (r["doc_id"], *(r[c] for c in BASE)))) for r in q.quality_report(odd).collect())
    assert got == sorted(tuple(map(repr, (r["doc_id"], *plain(r["text"])))) for r in odd.collect())
    kept = q.keep_good(odd).collect()
    assert {r["doc_id"] for r in kept} == {6, 7, 15, None} and sum(r["doc_id"] == 7 for r in kept) == 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab \n#é", max_size=60), max_size=5))
def test_measures_equal_plain_counting(texts):
    data, offsets = flat(pa.array(texts, pa.string()))
    m = q.measure(data, offsets, (5, 6, 7))
    for k, text in enumerate(texts):
        assert tuple(int(m[c][k]) for c in BASE[:-1]) == plain(text)[:-1]


def test_verdicts_follow_labels(spark):
    import pandas as pd

    folder = "/root/testdata/sf0.01"
    kept = QUERIES["op1_quality"](spark, folder).select("doc_id", "kept", "base_failed").toPandas()
    both = kept.merge(pd.read_parquet(f"{folder}/labels.parquet"), on="doc_id")
    good, bad = both[both.quality == 1], both[both.quality == 0]
    assert good[~good.base_failed].kept.all()
    assert bad.kept.mean() < 0.05


def test_slices_cover_every_row_once():
    texts = pa.array(["a" * k for k in range(50)] + [None, ""])
    data, offsets = flat(texts)
    from tidemark.llm.common import slices

    spans = list(slices(offsets, 100))
    assert [a for a, _ in spans[1:]] == [b for _, b in spans[:-1]] and spans[-1][1] == 52
    assert [len(Words(d, o).counts) for _, _, d, o in text_slices(texts)] == [52]


def test_language_accuracy_and_determinism(spark, documents):
    folder = "/root/testdata/sf0.01"
    import pandas as pd

    truth = pd.read_parquet(f"{folder}/documents.parquet").set_index("doc_id").lang
    first = QUERIES["op5_language"](spark, folder).toPandas().set_index("doc_id").sort_index()
    assert len(first) == len(truth)
    held = first[first.held_out]
    assert (held.lang_pred == truth[held.index]).mean() > 0.98
    assert not first.rejected.any() and first.score.between(0, 1).all()
    again = QUERIES["op5_language"](spark, folder).toPandas().set_index("doc_id").sort_index()
    assert first.equals(again)


def test_language_odd_rows(spark, odd, none):
    model = train_language_model(odd)
    got = predict_languages(odd, model).collect()
    assert len(got) == odd.count()
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert {k for k, r in by.items() if r["lang_pred"] == "und"} == {1, 2, 3, 12}
    assert all(r["score"] == 0 and r["rejected"] for k, r in by.items() if k in (1, 2, 3))
    empty = train_language_model(none)
    assert {r["lang_pred"] for r in predict_languages(odd, empty).collect()} == {"und"}
    assert keep_identified(odd, empty).count() == 0 and predict_languages(none, model).count() == 0
    assert keep_identified(odd, model).columns == odd.columns


def test_language_sample_is_bounded(spark):
    from tidemark.llm.langid import sample_features

    df = spark.range(4000).selectExpr("id AS doc_id", "concat('some words of text ', id) AS text", "if(id % 3 = 0, 'a', 'b') AS lang")
    rows = sample_features(df, "lang", "text", "doc_id", LangRules(sample_rows=100))
    assert 120 < len(rows) < 280


def test_letters_of_any_script():
    data, offsets = flat(pa.array(["12 .", "漢", "é", "", "٣"]))
    assert has_letter(data, offsets).tolist() == [False, True, True, False, False]
    assert np.array_equal(offsets, [0, 4, 7, 9, 9, 11])
