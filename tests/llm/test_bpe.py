"""Byte-level BPE against the tiktoken library, at any chunking."""

import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from chainframe.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
DATA = open(PATH, "rb").read()
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, DATA.splitlines())}
PLAIN = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
TEXTS = [None, "", " ", "  a  b\n\n c's don't\tx ", "naïve ümläut 漢字かな \U0001f600 end", "a" * 3000, "hello world " * 500, "ab \n" * 800 + "9" * 700, "\n" * 900, "<|endoftext|>", "x" * 1500 + " y" * 900]


@pytest.mark.parametrize(("chunk", "overlap"), [(65_536, 1_024), (64, 16), (300, 40)])
def test_round_trip(spark, chunk, overlap):
    docs = spark.createDataFrame(list(enumerate(TEXTS * 2)), "doc_id long, text string")
    got = bpe.decode(bpe.encode(docs, PATH, public_tokenizers.PATTERN, chunk_chars=chunk, overlap_chars=overlap), PATH).collect()
    assert len(got) == 2 * len(TEXTS)
    for r in got:
        text = TEXTS[r.doc_id % len(TEXTS)] or ""
        assert list(r.ids) == PLAIN.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab 'sted\n\t.9é漢　\U0001f600"), max_size=60))
def test_encoder_units(text):
    assert bpe._Encoder(DATA, public_tokenizers.PATTERN).encode(text) == PLAIN.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=80))
def test_merge_of_bytes(piece):
    assert bpe.merge(piece, RANKS) == PLAIN._core_bpe.encode_single_piece(piece)


def test_query_over_documents(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in queries.table(spark, sf_dir, "documents").collect()}
    for r in queries.op6_byte_bpe(spark, sf_dir).collect():
        ids = PLAIN.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_empty_and_clashing_columns(spark):
    assert bpe.encode(spark.createDataFrame([], "doc_id long, text string"), PATH, public_tokenizers.PATTERN).collect() == []
    got = bpe.encode(spark.createDataFrame([(None, "a b " * 50, 7)] * 2, "doc_id long, text string, chunk long"), PATH, public_tokenizers.PATTERN, chunk_chars=20, overlap_chars=8)
    assert [(r.doc_id, r.chunk, list(r.ids)) for r in got.collect()] == [(None, 7, PLAIN.encode_ordinary("a b " * 50))] * 2


def test_columns_named_like_results_are_replaced(spark):
    docs = spark.createDataFrame([(1, "a b", "x", "y")], "doc_id long, text string, ids string, Decoded string")
    got = bpe.decode(bpe.encode(docs, PATH, public_tokenizers.PATTERN), PATH)
    assert got.columns == ["doc_id", "ids", "decoded"]
    assert (list(got.first().ids), bytes(got.first().decoded)) == (PLAIN.encode_ordinary("a b"), b"a b")
    assert bpe.encode(docs.select("text"), PATH, public_tokenizers.PATTERN).columns == ["ids"]


def test_decoding_null_and_unknown_ids(spark):
    rows = [(1, None), (2, []), (3, PLAIN.encode_ordinary("naïve a")), (4, None), (5, [0])]
    got = bpe.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), PATH).collect()
    assert {r.doc_id: bytes(r.decoded) for r in got} == {i: b"".join(PLAIN.decode_single_token_bytes(x) for x in ids or ()) for i, ids in rows}
    for wrong in (-1, max(RANKS.values()) + 1):
        with pytest.raises(Exception, match="(?i)bounds"):
            bpe.decode(spark.createDataFrame([([wrong],)], "ids array<int>"), PATH).collect()
    with pytest.raises(Exception, match="no token"):
        bpe.decode(spark.createDataFrame([([None],)], "ids array<int>"), PATH).collect()
