"""Encoding and decoding against the tokenizers library."""

from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratamerge.llm import bpe
from stratamerge.llm.common import documents, utf8
from stratamerge.llm.queries import tokenizer_path

ODD = [None, "", " ", "aaa aaaa  aaaaa\n\n don't WE'LL 'sx", "a" * 5000, "ab" * 2001, "<|endoftext|>x<|endoftext|><|endoftext|> <|endoftext|", "日本語 é ٣٤ 🎉🎉🎉̀", "\x00\x01\xa0  x", "zz" * 40_000 + " ", "ÿþ�"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(tokenizer_path())
    t.no_truncation()
    t.no_padding()
    return t


def ours(texts):
    v = bpe.vocabulary(tokenizer_path())
    data, offsets = utf8(pa.array(texts, pa.string()))
    ids, cuts = bpe.encode_texts(v, data, offsets)
    return [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], bpe.decode_ids(v, ids.astype(np.int64), cuts).to_pylist()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aab  '\nst1é🎉日̀Ġ<|>"), max_size=60) | st.text(max_size=40), min_size=1, max_size=6))
def test_texts_against_the_library(texts):
    t = Tokenizer.from_file(tokenizer_path())
    want = [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert ours(texts) == (want, [t.decode(ids, skip_special_tokens=False) for ids in want])


def test_odd_texts(library):
    ids, texts = ours(ODD)
    assert ids == [library.encode(x or "", add_special_tokens=False).ids for x in ODD] and texts == [x or "" for x in ODD]


def test_each_pair_is_taken_once_from_the_left():
    v = bpe.vocabulary(tokenizer_path())
    index = bpe.PairIndex()
    index.add(np.array([1, 4, 9]), np.array([7, bpe.NO_RANK, 3]))
    index.add(np.array([2, 5]), np.array([3, 3]))
    r, at = index.pop()
    assert (r, at.tolist()) == (3, [2, 5, 9]) and index.pop()[1].tolist() == [1] and not index.active
    ids, cuts = bpe.merge_words(v, np.zeros(0, np.uint8), np.zeros(3, np.int64))
    assert not len(ids) and cuts.tolist() == [0, 0, 0]


def test_table_round_trip(spark, sf_dir, library):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    more = spark.createDataFrame([(-i, x) for i, x in enumerate(ODD * 2)], docs.schema)
    docs = docs.union(more).withColumns({"own": F.lit("clash"), "ids": F.lit(1)})
    coded = bpe.encode(docs, tokenizer_path())
    assert coded.columns == ["doc_id", "own", "ids"]
    got = {(r["doc_id"], r["text"]): (bytes(r["ids"]), r["own"]) for r in bpe.decode(coded, tokenizer_path()).collect()}
    texts = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    assert got == {(i, x): (np.array(library.encode(x, add_special_tokens=False).ids, "<u4").tobytes(), "clash") for i, x in texts}


def test_op12_digests(spark, library):
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(ODD)], "doc_id long, text string")
    for r in bpe.op12_bpe(docs, tokenizer_path()).collect():
        text = ODD[r["doc_id"]] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256(text.encode()).hexdigest())
    assert bpe.op12_bpe(docs.limit(0), tokenizer_path()).collect() == []


def test_ids_that_are_no_text():
    v = bpe.vocabulary(tokenizer_path())
    lone = int(v.byte_ids[0xC3])
    assert bpe.decode_ids(v, np.array([lone, 10**6, int(v.byte_ids[65])]), np.array([0, 1, 1, 3])).to_pylist() == ["�", "", "A"]
