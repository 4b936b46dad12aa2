import hashlib
import math
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import lexical, rank_bpe, whitening
from tidemark.llm.common import flat
from tidemark.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library_ids(text):
    return np.array(LIBRARY.encode(text or "", add_special_tokens=False).ids, dtype="<u4").tobytes()


# ---- op11 -----------------------------------------------------------------------------------------------------


def test_ranks_equal_the_library_on_odd_rows(spark, odd, none):
    coded = rank_bpe.encode_by_ranks(odd, PATH)
    back = rank_bpe.decode_by_ranks(coded, PATH).collect()
    expected = sorted((repr(r["doc_id"]), library_ids(r["text"]), r["text"] or "") for r in odd.collect())
    assert sorted((repr(r["doc_id"]), bytes(r["ids"]), r["decoded"]) for r in back) == expected
    assert all(r["n_tokens"] == len(r["ids"]) // 4 for r in back)
    assert rank_bpe.decode_by_ranks(rank_bpe.encode_by_ranks(none, PATH), PATH).count() == 0


def test_rank_query_equals_the_library(spark, documents):
    got = {r["doc_id"]: r for r in QUERIES["op11_rank_bpe"](spark, SMALL).collect()}
    for row in documents.itertuples():
        ids = library_ids(row.text)
        text = LIBRARY.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)
        own = got[row.doc_id]
        assert (own["n_tokens"], own["ids_sha256"]) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert own["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("abet 's\n")), max_size=80), max_size=5))
def test_any_text_encodes_as_the_library(texts):
    assert rank_bpe.RankEncoder(PATH)(texts) == [library_ids(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=12))
def test_any_ids_decode_as_the_library(ids):
    raw = np.array(ids, dtype="<u4").tobytes()
    assert rank_bpe.decode_text(rank_bpe.rank_table(PATH), raw) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_special_tokens_can_be_plain_text():
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    text = "a <|endoftext|><|endoftext|> b<|endof"
    own = np.frombuffer(rank_bpe.RankEncoder(PATH, special_in_text=False)([text])[0], "<u4").tolist()
    assert own == plain.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(rank_bpe.RankEncoder(PATH)([text])[0], "<u4").tolist().count(50256) == 2


def test_long_words_long_texts_and_a_full_cache(monkeypatch):
    word = "".join(chr(97 + k * k % 26) for k in range(5000))
    texts = [word, "x" * 3000, "ab " * 3000 + word, None, "漢" * 400]
    expected = [library_ids(t) for t in texts]
    monkeypatch.setattr(rank_bpe, "LONG_TEXT", 1000)
    monkeypatch.setattr(rank_bpe, "WORDS_AT_ONCE", 7)
    monkeypatch.setattr(rank_bpe, "WORD_CACHE", 20)
    assert rank_bpe.RankEncoder(PATH)(texts) == expected


def test_heap_and_rows_agree():
    table, rng = rank_bpe.rank_table(PATH), np.random.default_rng(3)
    data = rng.choice(np.frombuffer(b"etaoin shrdlu", np.uint8), (300, 17))
    for rows, ids, bounds in rank_bpe.merge_rows(table, data):
        for r, own, cut in zip(rows, ids, bounds):
            assert own.tolist() == rank_bpe.merge_long(table, data[r].tobytes())
            sizes = [table.at[i + 1] - table.at[i] for i in own]
            assert np.diff(cut).tolist() == sizes


def test_other_tokenizer_files_are_refused():
    with pytest.raises(ValueError):
        rank_bpe.RankTable(public_tokenizers.path("word_bpe_49k.json"))


# ---- op12 -----------------------------------------------------------------------------------------------------


def matrices():
    rng = np.random.default_rng(0)
    turn = lambda n: np.linalg.qr(rng.standard_normal((n, n)))[0]
    of = lambda q, v: (q * np.array(v)) @ q.T
    yield np.cov(rng.standard_normal((40, 300)))
    yield of(turn(12), [5, 5, 5, 3, 3, 1, 1, 1, 1, 0.5, 0, 0])
    yield of(turn(20), 10.0 ** -np.arange(20))
    yield of(turn(9), [4, 3, 2, 1, 0, -1, -2, -3, -4])
    yield from (np.eye(5) * 3, np.zeros((4, 4)), np.array([[2.0]]), np.ones((6, 6)), np.zeros((0, 0)))


@pytest.mark.parametrize("a", list(matrices()), ids=range(9))
def test_divide_and_conquer_finds_the_eigenvectors(a):
    a = (a + a.T) / 2
    values, vectors = whitening.eigen(a)
    scale = max(1e-300, np.linalg.norm(a)) if len(a) else 1
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max(initial=0) <= 1e-13 * scale
    assert np.abs(a @ vectors - vectors * values).max(initial=0) <= 1e-13 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(a))).max(initial=0) <= 1e-13


def test_polar_factor_is_orthogonal():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((15, 15))
    a = a + a.T
    u = whitening.polar(a)
    assert np.abs(u @ u - np.eye(15)).max() < 1e-13
    assert np.linalg.eigvalsh(u @ a).min() > -1e-12  # u'a is positive semidefinite


def plain_whitening(vectors, components=32):
    x = np.floor(64 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    deviation = ((n * x - total) ** 2).sum(axis=1)
    z = (n * x - total) / n
    values, basis = np.linalg.eigh(z.T @ z / n)
    values, basis = values[::-1], basis[:, ::-1]
    return n, deviation, z @ basis[:, :components] / np.sqrt(values[:components]), values / values.sum()


def test_whitening_query_against_numpy(spark):
    import pandas as pd

    table = pd.read_parquet(f"{SMALL}/embeddings.parquet").sort_values("vec_id")
    table = table[[v is not None and len(v) > 0 and np.isfinite(v).all() for v in table.embedding]]
    n, deviation, white, share = plain_whitening(np.stack(table.embedding))
    got = QUERIES["op12_whitening"](spark, SMALL).toPandas().sort_values(["vec_id", "component"])
    assert len(got) == 32 * n and set(got.n) == {n}
    assert got.deviation.to_numpy()[::32].tolist() == deviation.tolist()
    own = got.whitened.to_numpy().reshape(n, 32)
    signs = np.sign((own * white).sum(axis=0))
    assert np.abs(own * signs - white).max() < 1e-8
    assert np.abs(got.explained.to_numpy()[:32] - share[:32]).max() < 1e-12
    assert got.identity_error.nunique() == 1 and got.identity_error.max() < 1e-9


def test_whitening_of_odd_rows(spark):
    schema = "vec_id long, embedding array<float>, component int, n long, whitened string"
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=3).tolist(), 7, 8, "w") for k in range(40)]
    rows += [(0, rows[0][1], 1, 2, None), (None, [0.5, -0.25, 4.0], 1, 2, None)]
    odd = [None, [], [1.0, None, 2.0], [1.0, float("nan"), 0.0], [float("inf"), 0.0, 0.0], [1.0, 2.0], [1e30, 0.0, 0.0]]
    df = spark.createDataFrame(rows + [(100 + k, v, 0, 0, "") for k, v in enumerate(odd)], schema).repartition(4)
    got = whitening.whiten(df).toPandas()
    n, deviation, white, _ = plain_whitening([r[1] for r in rows])
    assert len(got) == 3 * n == 3 * len(rows) and got.vec_id.isna().sum() == 3
    assert sorted(got.deviation) == sorted(np.repeat(deviation, 3))
    assert np.allclose(sorted(np.abs(got.whitened)), sorted(np.abs(white).ravel()), atol=1e-9)
    assert whitening.whiten(df.limit(0)).count() == 0 and whitening.whiten(df.filter("vec_id >= 100 AND vec_id <> 105 AND vec_id <> 101")).count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])], "vec_id long, embedding array<double>")).collect()
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [
        (1, 1, 0, None, None, None), (2, 1, 0, None, None, None)
    ]


def test_more_dimensions_than_rows_and_large_entries(spark):
    rng = np.random.default_rng(6)
    rows = [(k, (rng.normal(size=10) * 1e8).tolist()) for k in range(4)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas()
    assert len(got) == 40 and got.whitened.notna().sum() == 4 * 3  # three directions have variance
    assert got.identity_error.max() < 1e-6 and set(got[got.whitened.isna()].component) == set(range(4, 11))
    x = np.floor(64 * np.array([r[1] for r in rows])).astype(object) + 1_000_000
    exact = ((4 * x - x.sum(axis=0)) ** 2).sum(axis=1)
    expected = {k: (float(v) if v < 2**63 else None) for k, v in enumerate(exact)}
    assert {int(r.vec_id): None if np.isnan(r.deviation) else float(r.deviation) for r in got.itertuples()} == expected


# ---- op13 -----------------------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_ranking(docs, items, k=10):
    held = [(i, Counter(t)) for i, t in ((i, terms(t)) for i, t in docs) if t]
    n_docs, length = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in wanted.items():
        scores = []
        for doc, c in held:
            m = 10 + (90 * c.total() * n_docs) // length
            w = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            s = sum(w(t) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if s > 0:
                scores.append((-s, doc is not None, doc or 0))
        scores.sort()
        out += [(item, r, doc if known else None, -s) for r, (s, known, doc) in enumerate(scores[:k], 1)]
    return sorted(map(repr, out))


@pytest.fixture(scope="module")
def items(spark):
    rows = [
        (1, "The Cat, the mat", 1), (2, "w17 w18 word", 2), (3, None, 3), (4, "...", 4), (5, "漢字 ß é", 5), (1, "slept", 6), (None, "x" * 30_000 + " a-b", 7),
        (6, "nowhere at all", 8), (7, "one two ONE", 9),
    ]
    return spark.createDataFrame(rows, "item_id long, text string, rank int").repartition(2)


@pytest.mark.parametrize("block", [1 << 20, 64])
def test_ranking_against_brute_force(spark, odd, items, none, block):
    got = lexical.rank_documents(odd, items, block_bytes=block).collect()
    expected = plain_ranking([(r["doc_id"], r["text"]) for r in odd.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert sorted(repr((r["item_id"], r["rank"], r["doc_id"], r["score"])) for r in got) == expected
    if block > 64:
        assert lexical.rank_documents(none, items).count() == 0 and lexical.rank_documents(odd, items.limit(0)).count() == 0


def test_ranking_query_against_brute_force(spark, documents):
    import pandas as pd

    items = pd.read_parquet(f"{SMALL}/benchmark.parquet")
    got = QUERIES["op13_lexical"](spark, SMALL).collect()
    expected = plain_ranking(zip(documents.doc_id, documents.text), zip(items.item_id, items.text))
    assert sorted(repr((r["item_id"], r["rank"], r["doc_id"], r["score"])) for r in got) == expected


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abAB é.\x00-漢"), max_size=30), min_size=1, max_size=5), st.sets(st.sampled_from(["a", "ab", "b", "é", "aé", "漢"]), min_size=1))
def test_scan_counts_terms(texts, wanted):
    names = sorted(wanted)
    total, row, term, times = lexical.scanned(*flat(pa.array(texts)), lexical.automaton(names), len(names))
    assert total.tolist() == [len(terms(t)) for t in texts]
    expected = [(k, names.index(w), c) for k, t in enumerate(texts) for w, c in Counter(terms(t)).items() if w in wanted]
    assert sorted(zip(row.tolist(), term.tolist(), times.tolist())) == sorted(expected)


def test_pieces_of_long_texts_cut_no_term(monkeypatch):
    text = ("abc " * 50 + "x" * 90 + " ab\n") * 3 + "y" * 70
    names = ["abc", "ab", "x" * 90, "y" * 70]
    data, offsets = flat(pa.array([text]))
    monkeypatch.setattr(lexical, "LONG_BYTES", 32)
    total, _, term, times = lexical.scanned_long(data, lexical.automaton(names), 4)
    whole = lexical.scanned(data, offsets, lexical.automaton(names), 4)
    assert total.tolist() == whole[0].tolist() and dict(zip(term, times)) == dict(zip(whole[2], whole[3])) == {0: 150, 1: 3, 2: 3, 3: 1}
