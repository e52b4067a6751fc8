"""Byte-level BPE through a sentencepiece model made from the vocabulary.

The rank file's tokens become the pieces of a sentencepiece BPE model: each
byte is mapped to one printable character, a piece's score is its negative
rank, normalisation is the identity, and the model is serialised here,
field by field (the public protobuf wire format).  Merging the best-scored
neighbouring pair, leftmost first, is then merging the lowest rank.

A text is split by the pre-token pattern, and each match is encoded by
itself; a run of letters met before in the worker need not be encoded
again.  Decoding joins the pieces' bytes.

Defined results: null text is empty (no ids, the digest of no bytes);
repeated rows are encoded alike; an empty table gives no rows; very long
texts and runs are encoded whole; input columns named like the added ones
are replaced.
"""

from __future__ import annotations

import base64
import re
import struct
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from domainpulse.llm.common import TEXT_BATCH, documents, stored, text_or_empty, without

CACHED_CHUNKS = 300_000
ADDED = ("ids",)
#: White space as the rank library's patterns take it (fixed values).
WHITE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file; a token's place is its id."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return sorted(ranks, key=ranks.__getitem__)


def byte_characters() -> list[str]:
    """A visible character for each byte; U+2581, which sentencepiece treats specially, is none of them."""
    return [chr(0x4E00 + b) for b in range(256)]


def _field(number: int, payload: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(payload)) + payload


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out) + bytes([n])


def _number(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def serialise_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece ModelProto: BPE, pieces in rank order, then the unknown piece.

    Field numbers are those of the public sentencepiece_model.proto (fixed values).
    """
    chars = byte_characters()
    out = bytearray()
    for rank, token in enumerate(tokens):
        piece = "".join(chars[b] for b in token).encode()
        out += _field(1, _field(1, piece) + _varint(2 << 3 | 5) + struct.pack("<f", -float(rank)))
    out += _field(1, _field(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _number(3, 2))
    trainer = _number(3, 2) + _number(4, len(tokens) + 1) + _number(40, len(tokens))
    # no bos, eos or pad id: -1 as a ten-byte varint
    for number in (41, 42, 43):
        trainer += _number(number, (1 << 64) - 1)
    out += _field(2, trainer + _number(24, 0))
    normaliser = _field(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    out += _field(3, normaliser)
    return bytes(out)


class ByteBpe:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, tokens: list[bytes], model: bytes, pattern: str):
        import regex
        import sentencepiece

        self.tokens = tokens
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        own = pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]")
        self.pattern = regex.compile(own)
        # The pattern never joins across white space but for one space before a run of other
        # characters, so such runs can be looked up whole before they are split further.
        self.chunks = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
        self.table = str.maketrans({chr(b): c for b, c in enumerate(byte_characters())})
        self.known: dict[str, bytes] = {}

    def _encode_new(self, chunks: list[str]) -> None:
        matches = [self.pattern.findall(c) for c in chunks]
        mapped = [m.encode().decode("latin-1").translate(self.table) for ms in matches for m in ms]
        ids = iter(self.processor.encode(mapped, num_threads=1) if mapped else [])
        for chunk, ms in zip(chunks, matches):
            self.known[chunk] = np.asarray([i for _ in ms for i in next(ids)], dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.chunks.findall(t) for t in texts]
        new = set().union(*split).difference(self.known) if split else set()
        if len(self.known) + len(new) > CACHED_CHUNKS:
            self.known = {}
            new = set().union(*split)
        new = list(new)
        for i in range(0, len(new), 4096):
            self._encode_new(new[i:i + 4096])
        of = self.known.__getitem__
        return [b"".join(map(of, chunks)) for chunks in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=2)
def _codec(path: str, pattern: str) -> ByteBpe:
    """One codec per worker process, vocabulary and pattern."""
    tokens = read_ranks(path)
    return ByteBpe(tokens, serialise_model(tokens), pattern)


def encoder(path: str, pattern: str):
    """A column function from text to its ids (binary, little-endian uint32)."""

    @F.pandas_udf("binary")
    def encode(texts: pd.Series) -> pd.Series:
        return pd.Series(_codec(path, pattern).encode(texts.tolist()), dtype=object)

    return encode


def decoder(path: str, pattern: str):
    """A column function from ids to the text's bytes."""

    @F.pandas_udf("binary")
    def decode(ids: pd.Series) -> pd.Series:
        codec = _codec(path, pattern)
        return pd.Series([codec.decode(i) for i in ids], dtype=object)

    return decode


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` with ``ids``."""
    return without(docs, *ADDED).withColumn("ids", encoder(path, pattern)(text_or_empty()))


def decoded(ids: Column, path: str, pattern: str) -> Column:
    return decoder(path, pattern)(ids)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each document, whole texts."""
    import public_tokenizers as tok

    path = tok.path("byte_bpe_50k.tiktoken")
    encoded = encode_documents(docs.select("doc_id", "text"), path, tok.PATTERN)
    out = encoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(decoded(F.col("ids"), path, tok.PATTERN), 256).alias("decoded_sha256"))
    return stored(out, "byte-bpe", batch=TEXT_BATCH)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir))
