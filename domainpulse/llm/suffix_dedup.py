"""Repeated passages by a sparse suffix array.

1. Every document is cut into words; of the hashes of its ``GRAM``-word
   grams, each window of ``WINDOW`` grams selects its smallest (a
   minimiser).  The choice depends on the window's words alone, so two
   copies of a passage select the same places, at least one among its
   first ``WINDOW`` grams.
2. The suffixes at selected places are sorted by the hash of their first
   ``PREFIX`` words: what any passage of ``MIN_WORDS`` still has after its
   first selected place.  Places whose prefix also stands in another
   document are open; a repeated passage has open places in all its copies.
3. Every run of ``MIN_WORDS`` words whose own selected place is open is
   sorted by its hash, and each is tied to its neighbour with the same
   words from another document.  So a run shared by few is not lost among
   the many documents that share a shorter run inside it.
4. Neighbours are extended left and right, word by word, in the whole
   texts; matches of at least ``MIN_WORDS`` words, and their other copies
   in the same document, are the repeated passages.

Both sorts go first inside a task, which then hands on one place per
distinct hash, then among what the tasks hand on: a passage that stands in a
third of all documents costs one row per task.

Defined results: words are runs of anything but the six ASCII blanks, case
counts; null, empty and short texts have no spans; a repeat inside one
document is none across documents; rows with the same id and the same text
are one document; rows without id take part, other_id is then null; an empty table gives
no rows; input columns named like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domainpulse.llm.common import TEXT_BATCH, documents, small, stored, text_or_empty, without, word_count

MIN_WORDS, GRAM, WINDOW = 50, 5, 10
PREFIX = MIN_WORDS - WINDOW + 1
#: Selected places that a task holds before it sorts them and hands them on.
HELD = 1_000_000
ADDED = ("n_words", "repeated_words", "spans")
_MUL, _ADD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
_INVERSE = np.uint64(pow(int(_MUL), -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_hashes(text: str | None) -> np.ndarray:
    words = (text or "").encode().split()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def _runs(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` words, from differences of one polynomial over the document."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(_mixed(words) * _powers(_MUL, len(words)))])
    n = len(words) - length + 1
    # a run's sum of word[i] * MUL^i, divided by the power of its start
    return _mixed((sums[length:] - sums[:n]) * _powers(_INVERSE, n) + _ADD)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _grams(words: np.ndarray, gram: int) -> np.ndarray:
    grams = np.full(len(words) - gram + 1, gram, dtype=np.uint64)
    for i in range(gram):
        grams = _mixed(grams * _MUL + words[i:len(words) - gram + 1 + i])
    return grams


def chosen(grams: np.ndarray, window: int) -> np.ndarray:
    """The place that each window selects; the leftmost of equal hashes."""
    return np.lib.stride_tricks.sliding_window_view(grams, window).argmin(axis=1) + np.arange(len(grams) - window + 1)


def selected(words: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> np.ndarray:
    """Places of the minimisers."""
    if len(words) < gram:
        return np.zeros(0, np.int64)
    grams = _grams(words, gram)
    if len(grams) <= window:
        return np.array([int(grams.argmin())])
    return np.unique(chosen(grams, window))


def extend(x: np.ndarray, y: np.ndarray, i: int, j: int) -> tuple[int, int]:
    """How far words agree to the left of, and from, places i and j."""
    return _agree(x[:i][::-1], y[:j][::-1]), _agree(x[i:], y[j:])


def _agree(x: np.ndarray, y: np.ndarray) -> int:
    n, step, done = min(len(x), len(y)), 64, 0
    while done < n:
        differ = np.flatnonzero(x[done:min(n, done + step)] != y[done:min(n, done + step)])
        if len(differ):
            return done + int(differ[0])
        done, step = done + step, step * 4
    return n


HANDED = "key long, node long, place int, other long, other_place int"


def _neighbours(key, node, place):
    """Order of the places, the first of each key, and each one's predecessor from another document (or -1)."""
    order = np.lexsort((place, node, key))
    k, n = key[order], node[order]
    first = np.concatenate([[True], k[1:] != k[:-1]])
    # the last row before a run of the same document, if it has the same key
    turn = np.concatenate([[True], n[1:] != n[:-1]]) | first
    start = np.flatnonzero(turn)[np.cumsum(turn) - 1]
    before = np.where(first[start], -1, start - 1)
    return order, first, before


def _settled(held: list) -> Iterator[pd.DataFrame]:
    key, node, place = (np.concatenate(c) for c in zip(*held))
    order, first, before = _neighbours(key, node, place)
    key, node, place = key[order], node[order], place[order]
    tied = before >= 0
    # a place that is handed on names itself as the other
    yield pd.DataFrame({"key": key[first], "node": node[first], "place": place[first],
                        "other": node[first], "other_place": place[first]})
    if tied.any():
        yield pd.DataFrame({"key": _mixed(node[tied].view(np.uint64)).view(np.int64), "node": node[tied],
                            "place": place[tied], "other": node[before[tied]],
                            "other_place": place[before[tied]]}).drop_duplicates()


def _handed(keyed):
    """Ties inside a task, and the places it hands on, by what ``keyed`` says of a row: keys and their places."""

    def hand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, count = [], 0
        for rows in batches:
            for row in zip(*(rows[c] for c in rows.columns)):
                key, at = keyed(*row[1:])
                if not len(at):
                    continue
                held.append((key.view(np.int64), np.full(len(at), row[0], np.int64), at.astype(np.int32)))
                count += len(at)
                if count >= HELD:
                    yield from _settled(held)
                    held, count = [], 0
        if held:
            yield from _settled(held)

    return hand


NONE = np.zeros(0, np.uint64), np.zeros(0, np.int64)


def prefixes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first ``PREFIX`` words at the selected places, and these places."""
    words = word_hashes(text)
    if len(words) < MIN_WORDS:
        return NONE
    at = selected(words)
    at = at[at + PREFIX <= len(words)]
    return _runs(words, PREFIX)[at], at


def runs_at(text: str, open_places) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``MIN_WORDS`` words whose own selected place has an open prefix, and that place."""
    words = word_hashes(text)
    own = chosen(_grams(words, GRAM), WINDOW)[:len(words) - MIN_WORDS + 1]
    heads = _runs(words, PREFIX)
    # of the places with equal prefixes in one document, one may stand for all
    held = np.flatnonzero(np.isin(heads[own], heads[np.asarray(open_places, dtype=np.int64)]))
    return _runs(words, MIN_WORDS)[held], own[held]


def _ties(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by key: the ties found before, and each handed-on place with its neighbour."""
    columns = ["a", "a_place", "b", "b_place"]
    last = None
    for rows in batches:
        old = rows[rows["other"] != rows["node"]]
        yield old[["node", "place", "other", "other_place"]].set_axis(columns, axis=1)
        rows = rows[rows["other"] == rows["node"]]
        if not len(rows):
            continue
        c = [rows[k].to_numpy() for k in ("key", "node", "place")]
        if last is not None:
            c = [np.concatenate([[a], b]) for a, b in zip(last, c)]
        key, node, place = c
        tied = np.flatnonzero((key[1:] == key[:-1]) & (node[1:] != node[:-1])) + 1
        last = tuple(x[-1] for x in c)
        yield pd.DataFrame({"a": node[tied], "a_place": place[tied], "b": node[tied - 1], "b_place": place[tied - 1]})


def _tied(rows: DataFrame, keyed) -> DataFrame:
    """(a, a_place, b, b_place): each place of ``rows`` (node, ...) tied to one with the same key in another document.

    Of a document's places with one key, at least one is tied.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.mapInPandas(_handed(keyed), HANDED).repartition(partitions, "key").sortWithinPartitions(
        "key", "node", "place").mapInPandas(_ties, "a long, a_place int, b long, b_place int")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def _with_copies(words: np.ndarray, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """``spans`` with what stands in them a second time in the same document."""
    runs = _runs(words, MIN_WORDS)
    if not spans or len(np.unique(runs)) == len(runs):
        return spans
    inside = np.concatenate([runs[s:e - MIN_WORDS + 1] for s, e in spans])
    return merged([(int(i), int(i) + MIN_WORDS) for i in np.flatnonzero(np.isin(runs, inside))])


def _extended(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        out = []
        for a, b, places, ta, tb in zip(rows["a"], rows["b"], rows["places"], rows["a_text"], rows["b_text"]):
            x, y = word_hashes(ta), word_hashes(tb)
            found = []
            for p in sorted((int(p["a_place"]), int(p["b_place"])) for p in places):
                # inside the last match of the same alignment there is nothing new
                if found and found[-1][2] == p[0] - p[1] and p[0] < found[-1][1]:
                    continue
                left, right = extend(x, y, *p)
                if left + right >= MIN_WORDS:
                    found.append((p[0] - left, p[0] + right, p[0] - p[1]))
            mine = _with_copies(x, merged([f[:2] for f in found]))
            theirs = _with_copies(y, merged([(f[0] - f[2], f[1] - f[2]) for f in found]))
            out += [(a, s, e, b) for s, e in mine] + [(b, s, e, a) for s, e in theirs]
        yield pd.DataFrame(out, columns=["node", "start", "stop", "other"])


def _united(spans: list) -> list[dict]:
    """Overlapping spans as one, each with the smallest of its other documents."""
    rows: list[dict] = []
    for start, stop, other in sorted((int(s["start"]), int(s["stop"]), int(s["other"])) for s in spans):
        if rows and start <= rows[-1]["stop"]:
            rows[-1]["stop"] = max(rows[-1]["stop"], stop)
            rows[-1]["other"] = min(rows[-1]["other"], other)
        else:
            rows.append({"start": start, "stop": stop, "other": other})
    return rows


def _node():
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("doc_id").isNull(), text_or_empty())


def repeated_passages(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with n_words, repeated_words and spans.

    A span is (start, stop, other_id): words start to stop - 1 also stand in document other_id
    (one of those that share part of it).
    """
    docs = without(docs, *ADDED)
    slim = docs.select("doc_id", _node().alias("node"), text_or_empty().alias("text"))
    same = _tied(slim.select("node", "text"), prefixes).select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.col("a_place").alias("place")),
        F.struct(F.col("b").alias("node"), F.col("b_place").alias("place")))).alias("at")).select("at.*")
    places = stored(same.groupBy("node").agg(F.collect_set("place").alias("places")), "suffix-places")
    members = small(places.select(F.col("node").alias("m")))
    texts = stored(slim.join(members, F.col("node") == F.col("m")).groupBy("node").agg(
        F.min("doc_id").alias("id"), F.first("text").alias("text")).join(places, "node"), "suffix-texts")
    ties = stored(_tied(texts.select("node", "text", "places"), runs_at).distinct(), "suffix-ties", batch=None)
    # one direction per pair of documents
    swap = F.col("a") > F.col("b")
    pick = lambda x, y: F.when(swap, F.col(y)).otherwise(F.col(x))
    pairs = stored(
        ties.select(pick("a", "b").alias("a"), pick("b", "a").alias("b"), F.struct(
            pick("a_place", "b_place").alias("a_place"), pick("b_place", "a_place").alias("b_place")).alias("p"))
        .groupBy("a", "b").agg(F.collect_set("p").alias("places")), "suffix-pairs")
    side = lambda name: texts.select(F.col("node").alias(name), F.col("text").alias(f"{name}_text"))
    found = stored(
        pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "places", "a_text", "b_text").mapInPandas(
            _extended, "node long, start int, stop int, other long"), "suffix-spans", batch=TEXT_BATCH)
    united = found.groupBy("node").agg(F.collect_list(F.struct("start", "stop", "other")).alias("s"))
    unite = F.pandas_udf(lambda c: pd.Series([_united(x) for x in c], dtype=object),
                         "array<struct<start:int,stop:int,other:long>>")
    spans = stored(united.select("node", F.posexplode(unite("s")).alias("k", "s")), "suffix-united")
    ids = texts.select(F.col("node").alias("other"), F.col("id").alias("other_id"))
    named = spans.select("node", "k", "s.start", "s.stop", "s.other").join(ids, "other").groupBy(
        F.col("node").alias("_n")).agg(
            F.array_sort(F.collect_list(F.struct("start", "stop", "other_id"))).alias("_spans"),
            F.sum(F.col("stop") - F.col("start")).cast("long").alias("_words"))
    none = F.array().cast("array<struct<start:int,stop:int,other_id:long>>")
    return (
        docs.withColumn("_node", _node()).withColumn("n_words", word_count())
        .join(small(stored(named, "suffix-named")), F.col("_node") == F.col("_n"), "left")
        .withColumn("repeated_words", F.coalesce("_words", F.lit(0).cast("long")))
        .withColumn("spans", F.coalesce("_spans", none)).drop("_node", "_n", "_spans", "_words")
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(documents(spark, sf_dir).select("doc_id", "text")).drop("text")
