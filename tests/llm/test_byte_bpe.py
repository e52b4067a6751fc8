"""Byte-level BPE against the rank library, and the round trip."""

import hashlib

import numpy as np
import pytest
import public_tokenizers as tok
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001
from domainpulse.llm import byte_bpe

PATH = tok.path("byte_bpe_50k.tiktoken")
ODD = [
    "", " ", "  ", "\n", " \n word", "word  \n", "it's we'll I'd'd 'tis", "a  b   c\t\td\r\n", "don't▁stop▁", "x" * 5000,
    " " * 4000 + "end", "日本語 テスト", "\x1c\x1d a\x1eb", "\x85a\xa0b c d　e", "🙂🙂 é é",
    "1234567 89", "<|endoftext|>", "一乁仿 own mapping", "\x00\x01", "a​b", "<unk>", "ſt İi",
]


@pytest.fixture(scope="module")
def brute():
    ranks = {t: i for i, t in enumerate(byte_bpe.read_ranks(PATH))}
    return tiktoken.Encoding("own", pat_str=tok.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    tokens = byte_bpe.read_ranks(PATH)
    return byte_bpe.ByteBpe(tokens, byte_bpe.serialise_model(tokens), tok.PATTERN)


def ids_of(codec, text):
    return np.frombuffer(codec.encode([text])[0], "<u4").tolist()


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(codec, brute, text):
    assert ids_of(codec, text) == brute.encode_ordinary(text)
    assert codec.decode(codec.encode([text])[0]) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet=" \n\t'sdltrvea.1　\x1c", max_size=40))
def test_any_text(text):
    tokens = byte_bpe._codec(PATH, tok.PATTERN)
    ranks = {t: i for i, t in enumerate(tokens.tokens)}
    own = test_any_text.__dict__.setdefault("enc", tiktoken.Encoding(
        "own2", pat_str=tok.PATTERN, mergeable_ranks=ranks, special_tokens={}))
    assert ids_of(tokens, text) == own.encode_ordinary(text)


def test_query_against_the_rank_library(spark, brute):
    rows = byte_bpe.op5_byte_bpe(spark, SF001).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        ids = brute.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_nulls_repeats_clashes_and_empty(spark):
    docs = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (None, "a b", None)], "doc_id long, text string, ids string")
    out = byte_bpe.encode_documents(docs, PATH, tok.PATTERN)
    assert sorted(bytes(r["ids"]).hex() for r in out.collect())[:2] == ["", ""] and dict(out.dtypes)["ids"] == "binary"
    got = byte_bpe.digests(docs).where("doc_id = 1").collect()
    assert [(r["n_tokens"], r["decoded_sha256"]) for r in got] == [(0, hashlib.sha256(b"").hexdigest())] * 2
    assert byte_bpe.digests(docs.limit(0)).count() == 0
    assert out.select(F.col("doc_id")).count() == 3
