"""Token files: every id against the tokenizer run on whole texts, the file format, and partial reads."""

import zlib

import numpy as np
import public_tokenizers as tok
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF001
from domainpulse.llm import token_files as tf

PATH = tok.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)
WORDS = tf.WordEncoder(PATH)


def whole(text):
    return WHOLE.encode(text, add_special_tokens=False).ids


def by_words(text):
    return np.frombuffer(WORDS.encode([text])[0], "<u4").tolist()


@pytest.mark.parametrize("text", [
    "", " ", "á ́b", "It's  THE\tend\n\nΣΑΣ ΣΑΣ. x", "<|endoftext|> and <|startoftext|>x", "\x1ca\x85b c",
    "x" * 3000, "we'll 'll 12345", "İ ſ ß", "a ͅb", "é é ﬁ",
])
def test_words_give_the_ids_of_the_whole_text(text):
    assert by_words(text) == whole(text)


@pytest.mark.parametrize("around", ["{}", "x{}", "{}'s", "A{}B!!", "9{}'RE"])
def test_every_letter_and_sign_of_the_plain_words(around):
    text = " ".join(around.format(chr(c)) for c in range(1, 0x250))
    assert by_words(text) == whole(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=50) | st.text(alphabet=" \n\t'slt́aΣ. \x1c<|>", max_size=30))
def test_words_give_the_ids_of_any_text(text):
    assert by_words(text) == whole(text)


def test_query(spark):
    rows = sorted(tf.op2_token_files(spark, SF001).collect(), key=lambda r: r["doc_id"])
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    assert [r["doc_id"] for r in rows] == sorted(texts)
    start = 0
    for r in rows:
        ids = np.asarray(whole(texts[r["doc_id"]]) + [1], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_format_and_partial_reads(scratch):
    path = f"{scratch}/a.zst"
    w = tf.TokenFileWriter(path)
    docs = [np.arange(n, dtype="<u4").tobytes() for n in (5, 0, 70_000, 200_000, 3, 3)]
    for i, d in enumerate(docs):
        w.add(None if i == 1 else i, d)
    w.close()
    r = tf.TokenFile(path)
    assert r.ids(5) == docs[5] and r.decompressed == 1
    assert [r.ids(i) for i in range(6)] == docs
    # any zstd reader sees one stream of ids, as skippable frames are skipped
    with open(path, "rb") as f:
        assert zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read() == b"".join(docs)
    blob = bytearray(open(path, "rb").read())
    blob[18] ^= 1
    open(path, "wb").write(blob)
    damaged = tf.TokenFile(path)
    with pytest.raises(Exception):  # noqa: B017  zstd's own error, or the checksum's
        damaged.ids(0)


def test_nulls_repeats_clashes_and_empty(spark, scratch):
    docs = spark.createDataFrame(
        [(2, "b", 1), (None, "a a", 2), (2, None, 3), (2, "b", 4), (1, "", 5)], "doc_id long, text string, first long")
    index = tf.write_token_files(docs, f"{scratch}/o", PATH, files=3)
    back = tf.read_token_files(tf.file_starts(index), f"{scratch}/o").collect()
    back.sort(key=lambda r: r["file_start"] + r["first"])
    assert [r["doc_id"] for r in back] == [None, 1, 2, 2, 2]
    ids = [np.frombuffer(r["ids"], "<u4").tolist() for r in back]
    assert ids[0] == whole("a a") + [1] and ids[1] == [1]
    assert sorted(ids[2:]) == sorted([whole("b") + [1], [1], whole("b") + [1]])
    assert tf.write_token_files(docs.limit(0), f"{scratch}/e", PATH, files=2).count() == 0


def test_files_with_other_settings_are_encoded_whole(scratch):
    """Cutting texts into words holds for one kind of file only; any other is run on whole texts."""
    import json

    other = tok.path("byte_bpe_50k.json")
    file = json.load(open(PATH, encoding="utf-8"))
    file["normalizer"]["normalizers"].pop()  # no lower-casing
    cased = f"{scratch}/cased.json"
    json.dump(file, open(cased, "w", encoding="utf-8"))
    assert tf.parts_by_words(PATH) and not tf.parts_by_words(other) and not tf.parts_by_words(cased)
    texts = ["", "Two  Words\nand It's END", "naïve Σ <|endoftext|> x"]
    for path in (other, cased):
        one = Tokenizer.from_file(path)
        got = [np.frombuffer(b, "<u4").tolist() for b in tf.WordEncoder(path).encode(texts)]
        assert got == [one.encode(t, add_special_tokens=False).ids for t in texts]
