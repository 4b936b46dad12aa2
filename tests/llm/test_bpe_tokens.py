import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import bpe
from tidemark.llm import token_files as tf
from tidemark.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
WORDS = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    return np.array(bpe.encoding(PATH, PATTERN).encode_ordinary(text or ""), dtype="<u4").tobytes()


@pytest.mark.parametrize("chunk,overlap", [(1 << 16, 1 << 10), (400, 60), (64, 8), (7, 3)])
def test_chunks_change_nothing(spark, odd, chunk, overlap):
    got = bpe.encode_documents(odd, PATH, PATTERN, chunk_chars=chunk, overlap_chars=overlap)
    if chunk == 7:  # many chunks a text: leave the longest out of this one
        small = odd.filter("text IS NULL OR length(text) < 5000")
        got, odd = bpe.encode_documents(small, PATH, PATTERN, chunk_chars=chunk, overlap_chars=overlap), small
    expected = sorted((repr(r["doc_id"]), ids_of(r["text"])) for r in odd.collect())
    assert sorted((repr(r["doc_id"]), bytes(r["ids"])) for r in got.collect()) == expected


def test_decoding_returns_the_bytes(spark, odd, none):
    back = bpe.decode_documents(bpe.encode_documents(odd, PATH, PATTERN), PATH)
    assert sorted(bytes(r["decoded"]) for r in back.collect()) == sorted((r["text"] or "").encode() for r in odd.collect())
    assert bpe.encode_documents(none, PATH, PATTERN).count() == 0


def test_query_equals_the_library(spark, documents):
    got = {r["doc_id"]: r for r in QUERIES["op6_bpe"](spark, SMALL).collect()}
    for row in documents.itertuples():
        ids = ids_of(row.text)
        assert got[row.doc_id]["n_tokens"] == len(ids) // 4
        assert got[row.doc_id]["ids_sha256"] == hashlib.sha256(ids).hexdigest()
        assert got[row.doc_id]["decoded_sha256"] == hashlib.sha256(row.text.encode()).hexdigest()


def plain_tokens():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(WORDS)
    made.encode_special_tokens = True
    return lambda text: made.encode(text or "", add_special_tokens=False).ids + [2]


def test_token_files_equal_the_library(spark, documents):
    tokens, at = plain_tokens(), 0
    got = QUERIES["op9_token_files"](spark, SMALL).orderBy("start").collect()
    assert len(got) == len(documents)
    for row, own in zip(documents.sort_values("doc_id").itertuples(), got):
        ids = np.array(tokens(row.text), dtype="<u4")
        assert (own["doc_id"], own["start"], own["n_tokens"], own["ids_crc32"]) == (row.doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_token_files_odd_rows(spark, odd, none):
    tokens = plain_tokens()
    manifest = tf.write_files(odd, WORDS, shards=3)
    got = tf.read_files(manifest).orderBy("start").collect()
    key = lambda k: (k is not None, k or 0)
    assert [r["doc_id"] for r in got] == sorted((r["doc_id"] for r in odd.collect()), key=key)
    expected = sorted(zlib.crc32(np.array(tokens(r["text"]), "<u4").tobytes()) for r in odd.collect())
    assert sorted(r["ids_crc32"] for r in got) == expected
    assert sum(r["n_tokens"] for r in got) == got[-1]["start"] + got[-1]["n_tokens"]
    assert tf.read_files(tf.write_files(none, WORDS)).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=40))
def test_words_apart_encode_like_the_whole(text):
    from tidemark.llm.common import flat
    import pyarrow as pa

    ids, limits = tf.WordEncoder(WORDS, 2)(*flat(pa.array([text, None])))
    assert ids[: limits[1]].tolist() == plain_tokens()(text) and ids[limits[1] :].tolist() == [2]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=1500))
def test_elias_fano_selects(gaps):
    values = np.concatenate([[0], np.cumsum(np.array(gaps, dtype=np.int64))])
    low, high = tf.EliasFano.encode(values, int(values[-1]))
    own = tf.EliasFano(len(values), int(values[-1]), low, high)
    assert np.array_equal(own.select(0, len(values)), values)
    for a in range(0, len(values), 97):
        assert np.array_equal(own.select(a, min(len(values), a + 600)), values[a : a + 600])
    bits = 8 * (len(low) + len(high))
    assert bits <= len(values) * (3 + max(1, (int(values[-1]) // len(values)).bit_length())) + 64


def test_words_of_letters_are_encoded_together(monkeypatch):
    words = ["a", "ß", "straße", "zürich", "naïve", "ÿ", "unlikeliestword", "æon", "x" * 300, "th", "the"]
    odd = ["don't", "a1", "x÷y", "Ünter", "été!", "日本", "éa", "<|endoftext|>", "</w>", "aǽ"]
    encoder, texts = tf.WordEncoder(WORDS, 2), []
    own, one = encoder._encoded, plain_tokens()
    monkeypatch.setattr(encoder, "_encoded", lambda part, given: texts.extend(given) or own(part, given))
    listed = [w.encode() for w in (*words, *odd)]
    found = encoder._ids(listed)
    assert [np.frombuffer(x, encoder.kind).tolist() for x in found] == [one(w)[:-1] for w in (*words, *odd)]
    assert texts[0] == " ".join(words) and not set(words) & set(texts[1:])
    encoder.final = None  # rules that are not known: word by word
    encoder.young, encoder.old = {}, {}
    assert encoder._ids(listed) == found
    assert encoder._ids([b"one"]) == [np.array(one("one")[:-1], encoder.kind).tobytes()]


def test_words_are_remembered_from_task_to_task():
    assert tf.word_encoder(WORDS, 2) is tf.word_encoder(WORDS, 2)
    assert tf.word_encoder(WORDS, 2) is not tf.word_encoder(WORDS, 3)


def test_letters_that_the_vocabulary_lacks_are_encoded_word_by_word():
    encoder = tf.WordEncoder(WORDS, 2)
    listed = [b"one", b"two", b"three"]
    found = encoder._ids(listed)
    encoder.final, encoder.young = encoder.final.copy(), {}
    encoder.final[np.frombuffer(found[1], encoder.kind)[-1]] = False  # as if its last letter had left no id
    assert encoder._ids(listed) == found
