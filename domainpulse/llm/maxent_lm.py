"""LM scoring by a hashed maximum-entropy model with a class-factored softmax.

A token's probability is a product:

    P(class | context) * P(member | class, context) * P(word | member)

Members are the frequent training words, one each, and ``TAILS`` groups of all
other words by their last two bytes.  Members are ranked by count and cut
into classes of equal size.  Both softmaxes start from the members' counts
and add one weight row per context feature (``CLASS_GROUPS``,
``MEMBER_GROUPS``): the word before, the pair before, and the skips to the
second and third word before, hashed into tables of fixed size.  Inside a tail group a word has its Witten-Bell share, and the
group's share for new words belongs to any word that training did not meet.

1. Every training token is counted (per task, then summed by word): N, V and
   the counts table, which grows with the corpus and stays distributed.
2. Words of at least N / 2^``LOOKUP_BITS`` tokens, so at most 2^``LOOKUP_BITS`` of them,
   go to the tasks as a dictionary; those of at least N / 2^``HEAD_BITS``
   are members of their own.
3. Training: rounds over disjoint slices of the training documents, by hash, so
   that every document is learned from once.  A task goes through its
   documents in minibatches of adaptive gradient steps from the round's weights
   and hands on what it changed; the changes are averaged per table row, weighted by
   the row's tokens, in groups of at most ``FAN_IN`` tasks, level by level.
   The tables' size is a parameter; they are all that reaches the driver.
4. Scoring: one pass in numpy batches; words outside the dictionary
   go to a join with the counts table, one row per document and word.  Each
   such word has less than N / 2^``LOOKUP_BITS`` training tokens, so none is a hot key.

Defined results: a null text is empty and has one token, the end; a null id
is held out, not learned from; repeated rows are learned from and scored each;
without training tokens every token is new (base_score 0); an empty table
gives no rows; input columns named like the added ones are not read.
"""

from __future__ import annotations

import itertools
import math
import uuid
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from domainpulse.llm.common import TEXT_BATCH, documents, stored, text_or_empty

LOOKUP_BITS, HEAD_BITS, TAILS = 20, 13, 256
#: Rows of the class table and of the member table (powers of two), rows of a block that is handed on.
CLASS_ROWS, MEMBER_ROWS, BLOCK = 1 << 14, 1 << 15, 64
#: Slices of the training documents; round k learns from those of its range.
SLICES, ROUND_ENDS = 16, (2, 16)
#: Tokens of a minibatch, of a scored batch, and of a training task; step width; tasks per averaging group.
STEP, BATCH, TASK_TOKENS, RATE, FAN_IN = 4096, 1 << 17, 4_000_000, 0.25, 64
#: Distinct words that a counting task holds before it hands them on.
HELD_WORDS = 300_000
#: The end of a text: not a word, as words hold no white space.
END = b"\n"
#: Mass added to each member's count.
PRIOR = 0.5
#: Which context features weigh on the class and on the member: the word before (0), the pair before (1), skips (2, 3).
CLASS_GROUPS, MEMBER_GROUPS = [0, 1, 2], [0, 2, 3]
#: Largest logit.
TOP = np.float32(60.0)
LOG10 = math.log(10.0)


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, mod 5, is 1; no id: held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 1, F.lit(True))


def tokens(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased, then the end.  Bytes split at just the six white-space characters."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    words.append(END)
    return words


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: Counter = Counter()

    def flush():
        out = pd.DataFrame({"word": list(held), "n": list(held.values())})
        held.clear()
        return out

    for rows in frames:
        for text in rows["text"]:
            held.update(tokens(text))
            if len(held) > HELD_WORDS:
                yield flush()
    if held:
        yield flush()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) of every token of ``texts`` (text)."""
    partial = texts.select("text").mapInPandas(_count, "word binary, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """The frequent words with their counts, the members of the softmax, and their classes."""

    def __init__(self, words: list[tuple[bytes, int]], train_tokens: int, distinct: int, tails: dict[int, tuple[int, int]]):
        """``words``: the frequent ones, most frequent first; ``tails``: tokens and words of each tail group."""
        self.train_tokens, self.distinct = train_tokens, distinct
        self.index = {w: i for i, (w, _) in enumerate(words)}
        self.counts = np.array([n for _, n in words], dtype=np.float64)
        heads = sum(1 for _, n in words if n * (1 << HEAD_BITS) >= train_tokens)
        self.heads, self.members = heads, heads + TAILS
        self.tail_tokens = np.array([tails.get(t, (0, 0))[0] for t in range(TAILS)], dtype=np.float64)
        self.tail_words = np.array([tails.get(t, (0, 0))[1] for t in range(TAILS)], dtype=np.float64)
        # member before ranking: a head's own index, else heads + its tail group
        raw = np.arange(len(words))
        raw[heads:] = heads + tail_groups_of(w for w, _ in words[heads:])
        mass = np.concatenate([self.counts[:heads], self.tail_tokens]) + PRIOR
        order = np.argsort(-mass, kind="stable")
        rank = np.empty(self.members, dtype=np.int64)
        rank[order] = np.arange(self.members)
        self.word_member = rank[raw] if len(raw) else raw
        self.tail_member = rank[heads:]
        self.width = math.isqrt(self.members - 1) + 1
        self.classes = -(-self.members // self.width)
        padded = np.zeros(self.classes * self.width)
        padded[:self.members] = mass[order]
        padded = padded.reshape(self.classes, self.width)
        self.class_bias = np.log(padded.sum(1) / padded.sum()).astype(np.float32)
        with np.errstate(divide="ignore"):
            self.member_bias = np.maximum(np.log(padded / padded.sum(1, keepdims=True)), -1e4).astype(np.float32)
        # log10 P(word | member) of the frequent words
        size = self.tail_tokens + self.tail_words
        self.tail_size = np.log10(np.where(size > 0, size, 1.0))
        self.tail_new = np.log10(np.where(self.tail_words > 0, self.tail_words, 1.0))
        inside = raw[heads:] - heads
        self.word_share = np.zeros(len(words))
        self.word_share[heads:] = np.log10(self.counts[heads:]) - self.tail_size[inside]
        self.base_unit = math.log10(train_tokens + 0.5 * (distinct + 1))

    def number(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
        """(dictionary index or -1, member) of each word, and the words of index -1 in order with their tail groups."""
        found = np.fromiter(map(self.index.get, words, itertools.repeat(-1)), dtype=np.int64, count=len(words))
        member = self.word_member[found] if len(self.word_member) else np.zeros(len(words), dtype=np.int64)
        at = np.flatnonzero(found < 0)
        rare = [words[i] for i in at]
        groups = tail_groups_of(rare)
        member[at] = self.tail_member[groups]
        return found, member, rare, groups


def tail_groups_of(words: Iterable[bytes]) -> np.ndarray:
    crc = zlib.crc32
    return np.array([crc(w[-2:]) for w in words], dtype=np.int64) % TAILS


def tail_groups(word: str = "word") -> Column:
    last = F.when(F.octet_length(word) > 2, F.expr(f"substring({word}, -2, 2)")).otherwise(F.col(word))
    return (F.crc32(last) % TAILS).cast("int")


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def context_features(member: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(4, tokens) hashes of each token's context; ``starts`` marks the first token of each text."""
    n = len(member)
    place = np.arange(n) - np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    back = []
    for k in (1, 2, 3):
        before = np.zeros(n, dtype=np.uint64)
        before[k:] = member[:-k] + 1 if n > k else 0
        before[place < k] = 0  # 0: before the text
        back.append(before)
    one, two, three = back
    salt = np.uint64(0x9E3779B97F4A7C15)
    keys = (one * np.uint64(8), (one * np.uint64(1 << 24) + two) * np.uint64(8) + np.uint64(1),
            two * np.uint64(8) + np.uint64(2), three * np.uint64(8) + np.uint64(3))
    return np.stack([_mix((k + np.uint64(1)) * salt) for k in keys])


class Tables:
    """The weights: a row of class weights per context hash, a row of member weights per hash of context and class."""

    def __init__(self, vocabulary: Vocabulary, weights: tuple[np.ndarray, np.ndarray] | None = None):
        self.vocabulary = vocabulary
        self.weights = weights or (np.zeros((CLASS_ROWS, vocabulary.classes), np.float32),
                                   np.zeros((MEMBER_ROWS, vocabulary.width), np.float32))

    def rows(self, features: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = (features[CLASS_GROUPS] & np.uint64(CLASS_ROWS - 1)).astype(np.uint16)  # 16 bits sort by radix
        second = _mix(features[MEMBER_GROUPS] + (cls.astype(np.uint64) + np.uint64(1)) * np.uint64(0x94D049BB133111EB))
        return first, (second & np.uint64(MEMBER_ROWS - 1)).astype(np.uint16)

    def _exponentials(self, table: int, bias: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(e to the logits, their sums)."""
        out = np.take(self.weights[table], rows[0], axis=0)
        for r in rows[1:]:
            out += np.take(self.weights[table], r, axis=0)
        out += bias
        np.minimum(out, TOP, out=out)
        np.exp(out, out=out)
        return out, out @ np.ones(out.shape[1], np.float32)

    def _factors(self, member: np.ndarray, features: np.ndarray):
        """(table, weight rows, bias, the token's own column) of the class and of the member in it."""
        cls, inside = np.divmod(member, self.vocabulary.width)
        first, second = self.rows(features, cls)
        return (0, first, self.vocabulary.class_bias, cls), (1, second, self.vocabulary.member_bias[cls], inside)

    def log_probabilities(self, member: np.ndarray, features: np.ndarray) -> np.ndarray:
        """Natural log P(member | context) of each token."""
        out = np.zeros(len(member))
        for i in range(0, len(member), STEP):
            part = slice(i, i + STEP)
            here = np.arange(len(member[part]))
            for table, rows, bias, pick in self._factors(member[part], features[:, part]):
                powers, total = self._exponentials(table, bias, rows)
                # a member so unlikely that its power is 0 keeps the least number above 0
                out[part] += np.log(np.maximum(powers[here, pick].astype(np.float64) / total, 1e-300))
        return out

    def learn(self, member: np.ndarray, features: np.ndarray, squares: list[np.ndarray], touched: list[np.ndarray]) -> None:
        """Gradient steps through the tokens, with a step width per row that shrinks with its past gradients."""
        for i in range(0, len(member), STEP):
            part = slice(i, i + STEP)
            n = len(member[part])
            here = np.arange(n)
            for t, rows, bias, pick in self._factors(member[part], features[:, part]):
                gradient, total = self._exponentials(t, bias, rows)
                gradient *= (-1.0 / total)[:, None]
                gradient[here, pick] += 1.0
                flat = rows.ravel()
                order = np.argsort(flat, kind="stable")
                placed = flat[order]
                begin = np.flatnonzero(np.concatenate([[True], placed[1:] != placed[:-1]]))
                row, times = placed[begin], np.diff(begin, append=len(flat))
                source = order % n
                added = np.take(gradient, source[begin], axis=0)  # rows met once are done
                again = np.flatnonzero(times > 1)
                if len(again):
                    many = np.repeat(times > 1, times)
                    starts = np.cumsum(times[again]) - times[again]
                    added[again] = np.add.reduceat(np.take(gradient, source[many], axis=0), starts, axis=0)
                past = squares[t][row] + np.einsum("ij,ij->i", added, added) / added.shape[1]
                squares[t][row] = past
                touched[t][row] += times
                added *= (RATE / np.sqrt(past + 1.0))[:, None]
                self.weights[t][row] += added


def _token_batches(frames: Iterable[pd.DataFrame], size: int = BATCH):
    """(rows, words, lengths): whole texts, about ``size`` words at a time (a longer text is a batch of its own)."""
    for rows in frames:
        begin, words, lengths = 0, [], []
        for k, text in enumerate(rows["text"]):
            own = tokens(text)
            words += own
            lengths.append(len(own))
            if len(words) >= size or k == len(rows) - 1:
                yield rows.iloc[begin:k + 1], words, np.array(lengths)
                begin, words, lengths = k + 1, [], []


def _starts(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    marks = np.zeros(int(lengths.sum()), dtype=bool)
    marks[begin] = True
    return begin, marks


CHANGES = "task long, tab int, block int, tokens binary, change binary"


def _train(shipped):
    """A task's changes to the tables, by blocks of rows."""

    def train(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables: Tables = shipped.value
        before = tables.weights
        learned = Tables(tables.vocabulary, tuple(w.copy() for w in before))
        squares = [np.zeros(len(w), np.float32) for w in before]
        touched = [np.zeros(len(w), np.float32) for w in before]
        for _, words, lengths in _token_batches(frames):
            member = tables.vocabulary.number(words)[1]
            learned.learn(member, context_features(member, _starts(lengths)[1]), squares, touched)
        task = uuid.uuid4().int >> 65
        for t in range(len(before)):
            change = (learned.weights[t] - before[t]).reshape(-1, BLOCK, before[t].shape[1])
            counts = touched[t].reshape(-1, BLOCK)
            blocks = np.flatnonzero(counts.any(axis=1))
            for i in range(0, len(blocks), 64):
                some = blocks[i:i + 64]
                yield pd.DataFrame({
                    "task": task, "tab": t, "block": some, "tokens": [counts[b].tobytes() for b in some],
                    "change": [change[b].astype(np.float16).tobytes() for b in some]})

    return train


def _average(rows: pd.DataFrame) -> pd.DataFrame:
    counts = np.stack([np.frombuffer(b, np.float32) for b in rows["tokens"]]).astype(np.float64)
    changes = np.stack([np.frombuffer(b, np.float16) for b in rows["change"]]).astype(np.float64)
    changes = changes.reshape(len(rows), counts.shape[1], -1)
    total = counts.sum(axis=0)
    mean = (changes * counts[:, :, None]).sum(axis=0) / np.maximum(total, 1.0)[:, None]
    return pd.DataFrame({"task": rows["task"].iloc[:1], "tab": rows["tab"].iloc[:1], "block": rows["block"].iloc[:1],
                         "tokens": [total.astype(np.float32).tobytes()], "change": [mean.astype(np.float16).tobytes()]})


def trained(tables: Tables, texts: DataFrame, token_count: int) -> Tables:
    """The tables after one round over ``texts``."""
    spark = texts.sparkSession
    shipped = spark.sparkContext.broadcast(tables)  # bounded: the table sizes and 2^LOOKUP_BITS words
    tasks = max(1, -(-token_count // TASK_TOKENS))
    changes = texts.select("text").coalesce(tasks).mapInPandas(_train(shipped), CHANGES)
    changes = stored(changes, "lm-changes", TEXT_BATCH)
    left = changes.agg(F.count_distinct("task")).first()[0]
    while left:
        groups = -(-left // FAN_IN)
        changes = changes.groupBy("tab", "block", F.pmod(F.xxhash64("task"), F.lit(groups)).alias("group")).applyInPandas(
            _average, CHANGES)
        left = groups if groups > 1 else 0
        changes = stored(changes, "lm-changes") if left else changes
    weights = [w.copy() for w in tables.weights]
    for r in changes.collect():  # at most one row per block of the tables
        block = slice(r["block"] * BLOCK, (r["block"] + 1) * BLOCK)
        weights[r["tab"]][block] += np.frombuffer(r["change"], np.float16).reshape(BLOCK, -1)
    shipped.destroy()
    return Tables(tables.vocabulary, tuple(weights))


def learn_vocabulary(counts: DataFrame) -> Vocabulary:
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    n, distinct = int(total[0]), int(total[1])
    frequent = counts.where(F.col("n") * (1 << LOOKUP_BITS) >= n).collect()  # at most 2^LOOKUP_BITS rows
    words = sorted(((bytes(r["word"]), int(r["n"])) for r in frequent), key=lambda w: (-w[1], w[0]))
    tails = counts.where(F.col("n") * (1 << HEAD_BITS) < n).groupBy(tail_groups().alias("t")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("w")).collect()  # TAILS rows
    return Vocabulary(words, n, distinct, {r["t"]: (int(r["n"]), int(r["w"])) for r in tails})


class LanguageModel:
    """Counts (word, n) as a stored table, and the trained tables."""

    def __init__(self, counts: DataFrame, tables: Tables):
        self.counts, self.tables = counts, tables

    def score(self, docs: DataFrame) -> DataFrame:
        """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs`` (doc_id, text)."""
        spark = docs.sparkSession
        kind = docs.schema["doc_id"].dataType.simpleString()
        shipped = spark.sparkContext.broadcast(self.tables)
        first = docs.select("doc_id", "text").mapInArrow(
            _score(shipped), f"row string, doc_id {kind}, n_tokens long, n_known long, base double, own double, "
                             "rare array<binary>, times array<int>")
        first = stored(first, "lm-scores", TEXT_BATCH)
        shipped.destroy()
        rare = first.select("row", F.explode(F.arrays_zip(F.col("rare").alias("word"), F.col("times").alias("n"))).alias("r")).select(
            "row", "r.*")
        fresh = F.array(*[F.lit(float(v)) for v in self.tables.vocabulary.tail_new])  # TAILS numbers
        counts = self.counts.select(F.col("word").alias("_word"), F.col("n").alias("c"))
        met = rare.join(counts, F.col("word") == F.col("_word"), "left")
        n, c = F.col("n"), F.col("c")
        added = met.groupBy(F.col("row").alias("_row")).agg(
            F.sum(F.when(c.isNotNull(), n).otherwise(0)).alias("known"),
            F.sum(n * F.log10(F.coalesce(c, F.lit(0)) + 0.5)).alias("rare_base"),
            F.sum(n * F.coalesce(F.log10(c.cast("double")), F.element_at(fresh, tail_groups() + 1))).alias("rare_own"))
        unit = self.tables.vocabulary.base_unit
        plus = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
        return first.join(added, F.col("row") == F.col("_row"), "left").select(
            "doc_id", "n_tokens", plus("n_known", "known").cast("long").alias("n_known"),
            F.lit(self.tables.vocabulary.train_tokens).cast("long").alias("train_tokens"),
            (plus("base", "rare_base") - F.col("n_tokens") * F.lit(unit)).alias("base_score"),
            plus("own", "rare_own").alias("score"))


def _score(shipped):
    """Each row's scores as far as the dictionary goes, and its other words with how often it holds them."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: Tables = shipped.value
        v = tables.vocabulary
        task, k = uuid.uuid4().hex, 0
        count_log = np.append(np.log10(v.counts + 0.5), 0.0)  # the last one stands for index -1
        share = np.append(v.word_share, 0.0)
        for batch in batches:
            rows = pd.DataFrame({"text": batch.column("text").to_pylist()})
            for some, words, lengths in _token_batches([rows]):
                found, member, rare, groups = v.number(words)
                begin, marks = _starts(lengths)
                own = tables.log_probabilities(member, context_features(member, marks)) / LOG10 + share[found]
                # a word's share of its tail group less its count, which the join brings
                own[found < 0] -= v.tail_size[groups]
                sums = lambda values: pa.array(np.add.reduceat(values, begin))
                at, kept, times, ends = 0, [], [], [0]
                for m in np.add.reduceat((found < 0).astype(np.int64), begin).tolist():
                    held = Counter(rare[at:at + m])
                    kept += held.keys()
                    times += held.values()
                    ends.append(len(kept))
                    at += m
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.array([f"{task}{k + i}" for i in range(len(some))]),
                    batch.column("doc_id").slice(int(some.index[0]), len(some)), pa.array(lengths),
                    sums((found >= 0).astype(np.int64)), sums(count_log[found]), sums(own),
                    pa.ListArray.from_arrays(ends, pa.array(kept, pa.binary())),
                    pa.ListArray.from_arrays(ends, pa.array(times, pa.int32()))],
                    ["row", "doc_id", "n_tokens", "n_known", "base", "own", "rare", "times"])
                k += len(some)

    return score


def fit_language_model(docs: DataFrame) -> LanguageModel:
    """A model of every row of ``docs`` (doc_id, text)."""
    counts = stored(word_counts(docs), "lm-counts", TEXT_BATCH)
    vocabulary = learn_vocabulary(counts)
    tables = Tables(vocabulary)
    if vocabulary.train_tokens:
        piece = F.pmod(F.xxhash64("doc_id", "text"), F.lit(SLICES))
        for begin, end in zip((0, *ROUND_ENDS), ROUND_ENDS):
            share = docs.where((piece >= begin) & (piece < end))
            tables = trained(tables, share, vocabulary.train_tokens * (end - begin) // SLICES)
    return LanguageModel(counts, tables)


def score_documents(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` scored by a model of those that are not held out."""
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    model = fit_language_model(rows.where(~held_out()))
    return model.score(rows).select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir))
