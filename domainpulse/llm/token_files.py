"""Token-id files: independent zstandard frames with a trailing seek table.

File layout (the public seekable zstd format, plus one index frame):

* data frames, each an independent zstd frame of little-endian uint32 ids.
  Frames end at document ends; a document above ``FRAME_BYTES`` has frames
  of its own;
* one skippable frame with the document index (doc_id, has_id, first token,
  token count), zstd-compressed, its crc32 in front;
* one skippable frame with the seek table: compressed size, decompressed
  size and checksum (low 32 bits of XXH64 of the content) of every data
  frame, the number of frames, a descriptor byte and the magic number.

A reader takes the seek table from the end of the file, then reads and
decompresses only the frames that hold the requested documents, checking
each frame's checksum.

Documents are dealt out by ranges of doc_id and sorted inside each file, so
file order and order in the file together are ascending doc_id order.  A
file is written under a temporary name and moved to its name, which depends
on its number only: a task that is run again replaces its file with the
same bytes.

Defined results: null text is an empty document (the end id alone); null
ids come first; repeated ids are separate documents, ordered by a digest of
their text; an empty table gives no file with documents; of the input, only doc_id and text are
read, whatever other columns there are.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from domainpulse.llm.common import TEXT_BATCH, documents, shared_path, stored, text_or_empty

END_ID = 1
FRAME_BYTES = 1 << 18
LEVEL = 3
#: Fixed values of the seekable zstd format.
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEK_MAGIC, CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
INDEX = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("first", "<i8"), ("n", "<i8")])
#: Words, and pieces of words, whose ids are kept at hand in a worker.
CACHED_WORDS, CACHED_PIECES = 1_000_000, 1_000_000

INDEX_COLUMNS = "file_no int, file string, place long, doc_id long, first long, n_tokens long"


#: Stands between words that are encoded in one call; it has one id of its own.
BETWEEN = "\x01"


#: Words of these characters only are cut into pieces here: they are letters, digits and signs that composing
#: and lower-casing leave or map one by one, so the tokenizer's own split is known for them.
_LETTERS = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
_PLAIN = re.compile(f"[\x21-\x7e{_LETTERS}]+")
#: The split pattern of the tokenizer file (a fixed value), narrowed to those characters in lower case.
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LETTERS}]+|[0-9]|[^a-z0-9{_LETTERS}]+")
_WIDE = [chr(c) for c in range(0x80, 0x180) if re.match(f"[{_LETTERS}]", chr(c))]
#: What may begin a special token of the file.
_SPECIAL = "<|"
#: The settings that cutting texts into words and pieces relies on (fixed values of the tokenizer file).
_NORMALIZERS = [("NFC", None, None), ("Replace", "\\s+", " "), ("Lowercase", None, None)]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def parts_by_words(path: str) -> bool:
    """Whether a tokenizer file has those settings; texts of any other are encoded whole."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    normalizer, split, model = file.get("normalizer") or {}, file.get("pre_tokenizer") or {}, file.get("model") or {}
    steps = [(n.get("type"), (n.get("pattern") or {}).get("Regex"), n.get("content")) for n in normalizer.get("normalizers", [])]
    cuts = split.get("pretokenizers", [])
    return (
        steps == _NORMALIZERS and [c.get("type") for c in cuts] == ["Split", "ByteLevel"]
        and cuts[0].get("pattern") == {"Regex": _SPLIT} and cuts[0].get("behavior") == "Removed" and bool(cuts[0].get("invert"))
        and not cuts[1].get("add_prefix_space") and not cuts[1].get("use_regex")
        and model.get("type") == "BPE" and model.get("dropout") is None and model.get("unk_token") is None
        and all(t["content"].startswith(_SPECIAL) and not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"])
                for t in file.get("added_tokens", [])))


class _Known(dict):
    """What is known by word; ``make`` says what a new word is."""

    def __missing__(self, word: str) -> bytes:
        return self.make(word)


class WordEncoder:
    """Ids of whole texts, word by word, and of words piece by piece.

    The tokenizer normalises, splits and merges inside runs between blanks only, so a text's ids
    are its words' ids in order, and a word met before need not be encoded again.  It merges inside
    the pieces of its split pattern only, so a new word of plain characters is its pieces' ids in
    order, and a new piece goes straight to the tokenizer's model.  Other new words are encoded whole,
    many in one call, with a character between them that none of them holds, and the ids are cut at its id.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_words = parts_by_words(path)
        if not self.by_words:
            return
        (self.between,) = self._whole(BETWEEN)
        self._forget()
        self.pieces: dict[str, bytes] = {}
        self.tokens = self.tokenizer.model.tokenize
        # The tokenizer's own spelling of each letter's bytes, as the model's vocabulary has it.
        self.spelt = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in _WIDE}

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _learn(self, words: list[str]) -> None:
        for i in range(0, len(words), 4096):
            part = words[i:i + 4096]
            ids = np.asarray(self._whole(f" {BETWEEN} ".join(part)), dtype="<u4")
            cuts = (np.flatnonzero(ids == self.between) * 4).tolist()
            raw = ids.tobytes()
            for word, start, stop in zip(part, [-4, *cuts], [*cuts, len(raw)]):
                self.ids[word] = raw[start + 4:stop]

    def _forget(self) -> None:
        self.ids = _Known({"": b""})
        self.ids.make = self._new
        self.waiting: set[str] = set()
        self.incomplete = False

    def _piece(self, piece: str) -> bytes:
        ids = [token.id for token in self.tokens(piece if piece.isascii() else piece.translate(self.spelt))]
        known = self.pieces[piece] = ids[0].to_bytes(4, "little") if len(ids) == 1 else struct.pack(f"<{len(ids)}I", *ids)
        return known

    def _plain(self, word: str) -> bytes:
        known = self.pieces.get
        pieces = _PIECE.findall(word.lower())
        if len(pieces) == 1:
            return known(pieces[0]) or self._piece(pieces[0])
        return b"".join([known(piece) or self._piece(piece) for piece in pieces])

    def _new(self, word: str) -> bytes:
        """The ids of a word not met before; none yet if it waits to be encoded with others."""
        if _PLAIN.fullmatch(word) and _SPECIAL not in word:
            found = self.ids[word] = self._plain(word)
            return found
        if BETWEEN in word:
            found = self.ids[word] = np.asarray(self._whole(word), dtype="<u4").tobytes()
            return found
        self.waiting.add(word)
        self.incomplete = True
        return b""

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_words:
            return [np.asarray(e.ids, dtype="<u4").tobytes()
                    for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        split = [t.replace("\n", " ").replace("\t", " ").split(" ") for t in texts]
        if len(self.ids) > CACHED_WORDS:
            self._forget()
        if len(self.pieces) > CACHED_PIECES:
            self.pieces = {}
        of = self.ids.__getitem__
        out, again = [], []
        for k, words in enumerate(split):
            self.incomplete = False
            out.append(b"".join(map(of, words)))
            if self.incomplete:
                again.append(k)
        self._learn(list(self.waiting))
        self.waiting.clear()
        for k in again:
            out[k] = b"".join(map(of, split[k]))
        return out


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    """One encoder per worker process, kept from task to task."""
    return WordEncoder(path)


class TokenFileWriter:
    """One file; call ``add`` per document in order, then ``close``."""

    def __init__(self, uri: str):
        self.fs, self.path = pafs.FileSystem.from_uri(uri)
        self.temporary = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.out = self.fs.open_output_stream(self.temporary)
        self.zstd = zstandard.ZstdCompressor(level=LEVEL)
        self.buffer, self.buffered, self.tokens = [], 0, 0
        self.frames, self.index = [], []

    def add(self, doc_id: int | None, ids: bytes) -> int:
        """Append a document; the number of tokens of the file before it."""
        first = self.tokens
        self.index.append((doc_id or 0, doc_id is not None, first, len(ids) // 4))
        self.tokens += len(ids) // 4
        if self.buffered and self.buffered + len(ids) > FRAME_BYTES:
            self._frame()
        while len(ids) > FRAME_BYTES:
            self.buffer, ids = [ids[:FRAME_BYTES]], ids[FRAME_BYTES:]
            self._frame()
        self.buffer.append(ids)
        self.buffered += len(ids)
        return first

    def _frame(self) -> None:
        raw = b"".join(self.buffer)
        packed = self.zstd.compress(raw)
        self.out.write(packed)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.buffer, self.buffered = [], 0

    def close(self) -> None:
        if self.buffered:
            self._frame()
        index = self.zstd.compress(np.array(self.index, dtype=INDEX).tobytes())
        self.out.write(struct.pack("<III", SKIPPABLE_INDEX, len(index) + 4, zlib.crc32(index)) + index)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), CHECKSUMS, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(table)) + table)
        self.out.close()
        self.fs.move(self.temporary, self.path)


class TokenFile:
    """Reads documents of one file by their place in it, touching only the frames that hold them."""

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        n, _, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC:
            raise ValueError(f"{uri}: no seek table")
        table = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), dtype="<u4").reshape(n, 3).astype("int64")
        self.packed, self.raw, self.checks = table.T if n else (np.zeros(0, "int64"),) * 3
        self.starts = np.concatenate([[0], np.cumsum(self.packed)])
        self.firsts = np.concatenate([[0], np.cumsum(self.raw)])
        at = int(self.starts[-1])
        kind, length, check = struct.unpack("<III", self._at(at, 12))
        index = self._at(at + 12, length - 4)
        if kind != SKIPPABLE_INDEX or zlib.crc32(index) != check:
            raise ValueError(f"{uri}: damaged document index")
        self.index = np.frombuffer(zstandard.ZstdDecompressor().decompress(index), dtype=INDEX)
        self.unzip = zstandard.ZstdDecompressor()
        self.decompressed = 0
        self.last: tuple[int, bytes] = (-1, b"")

    def _at(self, offset: int, size: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(size)

    def frame(self, i: int) -> bytes:
        if self.last[0] != i:
            raw = self.unzip.decompress(self._at(int(self.starts[i]), int(self.packed[i])))
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.checks[i]:
                raise ValueError(f"frame {i}: checksum differs")
            self.decompressed += 1
            self.last = (i, raw)
        return self.last[1]

    def ids(self, place: int) -> bytes:
        """The ids of the document at ``place``, as little-endian uint32."""
        lo = int(self.index["first"][place]) * 4
        hi = lo + int(self.index["n"][place]) * 4
        out, i = [], int(np.searchsorted(self.firsts, lo, "right")) - 1
        while lo < hi:
            start = int(self.firsts[i])
            out.append(self.frame(i)[lo - start:hi - start])
            lo, i = int(self.firsts[i + 1]), i + 1
        return b"".join(out)


def write_token_files(docs: DataFrame, out: str, tokenizer: str, files: int | None = None,
                      end_id: int = END_ID) -> DataFrame:
    """Encode ``docs`` into files under ``out``; the index, one row per document."""
    spark = docs.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    fs, root = pafs.FileSystem.from_uri(out)
    fs.create_dir(root)
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = writer = None
        for batch in batches:
            if not len(batch):
                continue
            if writer is None:
                file_no = int(batch["file_no"].iloc[0])
                name = f"tokens-{file_no:06d}.zst"
                encoder, writer, place = _encoder(tokenizer), TokenFileWriter(f"{out}/{name}"), 0
            rows = []
            for doc_id, ids in zip(batch["doc_id"], encoder.encode(batch["text"].tolist())):
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                first = writer.add(doc_id, ids + end)
                rows.append((file_no, name, place, doc_id, first, len(ids) // 4 + 1))
                place += 1
            index = pd.DataFrame(rows, columns=["file_no", "file", "place", "doc_id", "first", "n_tokens"])
            yield index.astype({"doc_id": "Int64"})
        if writer is not None:
            writer.close()

    # The id goes as text: a nullable integer column would reach pandas as floats.
    dealt = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
        .withColumn("_tie", F.xxhash64("text"))
        .repartitionByRange(files, F.col("doc_id").asc_nulls_first(), "_tie")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_tie", "text")
        .select(F.spark_partition_id().alias("file_no"), F.col("doc_id").cast("string").alias("doc_id"), "text")
    )
    return stored(dealt.mapInPandas(write, INDEX_COLUMNS), "token-index", batch=TEXT_BATCH)


def file_starts(index: DataFrame) -> DataFrame:
    """(file_no, file, file_start): tokens of all files before, one row per file."""
    per_file = index.groupBy("file_no", "file").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    return per_file.select("file_no", "file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("file_start"))


def read_token_files(files: DataFrame, out: str, batch: int = 64) -> DataFrame:
    """(file_start, place, doc_id, first, n_tokens, ids) of every document of ``files`` (file, file_start)."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for name, start in zip(rows["file"], rows["file_start"]):
                opened = TokenFile(f"{out}/{name}")
                index = opened.index
                for at in range(0, len(index), batch):
                    part = index[at:at + batch]
                    yield pd.DataFrame({
                        "file_start": start, "place": np.arange(at, at + len(part)),
                        "doc_id": pd.array(np.where(part["has_id"] == 1, part["doc_id"], 0), dtype="Int64"),
                        "has_id": part["has_id"] == 1, "first": part["first"], "n_tokens": part["n"],
                        "ids": [opened.ids(i) for i in range(at, at + len(part))]})

    read_back = files.select("file", "file_start").mapInPandas(
        read, "file_start long, place long, doc_id long, has_id boolean, first long, n_tokens long, ids binary")
    return read_back.withColumn("doc_id", F.when(F.col("has_id"), F.col("doc_id"))).drop("has_id")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = shared_path(spark, "token-files")
    out = out if "://" in out or out.startswith("/") else os.path.abspath(out)
    index = write_token_files(documents(spark, sf_dir), out, public_tokenizers.path("word_bpe_49k.json"))
    starts = stored(file_starts(index), "token-starts")
    files = max(1, starts.count())
    read = read_token_files(starts.repartition(files), out)
    return read.select(
        "doc_id", (F.col("file_start") + F.col("first")).alias("start"), "n_tokens",
        F.crc32("ids").cast("long").alias("ids_crc32"))
