"""Exact Jaccard join of word-shingle sets as a metric-space join.

1 - Jaccard is a metric.  Two documents link when their distance is at most
eps = 1 - threshold.

Random pivots alone cannot part a corpus: nearly all documents are at a
distance close to 1 from any pivot, so every triangle-inequality window
(2 eps wide) would hold nearly all documents.  So the outermost regions are
cut exactly in another way, and pivots work where distances spread:

1. *Families.*  A set is dealt into m blocks by shingle hash, m above the
   largest possible symmetric difference of a linked pair of that size
   (2 n eps / (2 - eps)); then a linked pair agrees in at least one whole
   block, even among the largest ones.  Documents that share a block are
   candidates; connected candidates form a family, and no link leaves a
   family.  Blocks are pre-aggregated in each task to one row per distinct
   block, so a block of a third of all documents costs one row per task.
   Families above ``LEAF`` are cut once more, by blocks that hold more than
   the shingles that are frequent in them.
2. *Regions.*  A family gets pivots: every set's distance to each is
   computed (sets within eps of a pivot link to it), and each set belongs to
   the Voronoi region of its nearest pivot.  Sets of the largest component
   found by the first pivots need not meet each other; the remaining sets are
   seeds, and any set y is replicated into the region of pivot p if some seed
   there may be within eps of it: d(y, p) lies in the region's window
   [min - eps, max + eps] of seed distances, and
   d(y, p) <= d(y, its nearest pivot) + 2 eps.  Regions are joined in the
   same way around new pivots.
3. A family of at most ``LEAF`` sets is joined so in one task, around
   ``LEAF_PIVOTS`` pivots at a time, far from each other, down to ``DIRECT``
   sets, or to where windows no longer part them, which are compared one by
   one.  Larger ones are measured in bounded chunks around sampled pivots, for
   ``DEPTH`` rounds; where windows no longer part them, they are compared
   chunk by chunk: seeds against members, each pair of chunks in a task of its own.

Sets are held as 64-bit shingle hashes (a chance of 2^-64 for a given pair
of shingles to be taken for one), all comparisons are on whole sets, and
the link rule is in whole numbers.

Defined results: null, empty and blank texts have an empty set and link
with nothing; a text with fewer words than a shingle has its whole word
sequence as its one shingle; equal sets link; a row without doc_id takes
part, its component_id is the smallest id reachable, null if there is none;
repeated rows are rows of one set; an empty table gives no rows; input
columns named like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domainpulse.llm.common import (
    TEXT_BATCH,
    bytes_in_files,
    discard,
    documents,
    is_small,
    screened,
    small,
    stored,
    text_or_empty,
    without,
)
from domainpulse.llm.components import Sets, components

#: Sets joined in one task, pivots of a larger region, sets per chunk, rounds of splitting.
LEAF, PIVOTS, CHUNK, DEPTH = 512, 16, 256, 2
#: Pivots of a region inside a task, and the sets that are compared without pivots.
LEAF_PIVOTS, DIRECT = 4, 24
#: Step between the block counts of two levels, and blocks per block that may differ.
STEP, SPARE = 1.5, 1.2
#: Sets whose blocks are pre-aggregated together in a task.
BLOCK_SETS = 2048
#: Bytes of stored block signatures that are shuffled at a time, up to this number of rounds.
ROUND_BYTES, ROUNDS = 64 << 20, 8
#: Bytes of a large family's texts that a task takes, and the share of its sets (one in ...) that makes a shingle frequent.
PIECE, SHARE = 8 << 20, 64
#: Splitting a region is given up when its parts would hold more than this many times its sets.
REPLICAS = 4
ADDED = ("n_shingles", "component_id")
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15))


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; a pair links when den * intersection >= num * union."""

    words: int = 5
    num: int = 80
    den: int = 100

    @property
    def eps(self) -> float:
        return 1 - self.num / self.den

    def apart(self, sizes: int) -> int:
        """The largest symmetric difference of a linked pair with this sum of sizes."""
        return sizes * (self.den - self.num) // (self.den + self.num)

    def linked(self, both, n_x, n_y):
        return self.den * both >= self.num * (n_x + n_y - both)


CONTRACT = Rule(words=3, num=90, den=100)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a whole text."""
    found = (text or "").encode().lower().split()  # bytes: A-Z only, and exactly the six blanks
    if not found:
        return np.zeros(0, dtype=np.uint64)
    word = np.fromiter(map(xxhash.xxh64_intdigest, found), dtype=np.uint64, count=len(found))
    width = min(words, len(found))
    out = np.full(len(found) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        out = _mixed(out * _MIX[2] + word[i:len(word) - width + 1 + i])
    return np.unique(out)


def levels(n: int, rule: Rule) -> list[tuple[int, int]]:
    """(blocks, largest difference) at each level where a set of ``n`` shingles may meet a linked one.

    A level's block count fits pairs up to some size; a set may meet linked sets at its own level and
    at the next, where larger partners are.  Sets so small that linked means equal need no blocks.
    """
    out = {}
    for size in (n, n * rule.den // rule.num):
        apart = rule.apart(2 * size)
        if apart:
            blocks = 3
            while blocks < SPARE * (apart + 1):
                blocks = max(blocks + 1, int(blocks * STEP))
            out[blocks] = apart
    return list(out.items())


def block_signatures(shingles: np.ndarray, rule: Rule, rare: np.ndarray | None = None) -> np.ndarray:
    """Signatures of the largest blocks at each level: equal blocks have equal signatures.

    Blocks of at least t shingles are signed, t as large as leaves more blocks than may differ.  Of a
    linked pair, the set with the larger t has one such block that does not differ, and the other set,
    with its smaller t, signs that block too.  (t is 0, and empty blocks are signed, only where nothing
    else is left.)  With ``rare``, a mask, only those shingles count towards t.
    """
    out = []
    for blocks, apart in levels(len(shingles), rule):
        place = (_mixed(shingles + np.uint64(blocks)) % np.uint64(blocks)).astype(np.int64)
        counts = np.bincount(place, minlength=blocks)
        rank = counts if rare is None else np.bincount(place[rare], minlength=blocks)
        least = int(np.sort(rank)[::-1][apart])
        signed = np.flatnonzero(rank >= least)
        order = np.argsort(place, kind="stable")
        sums = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(_mixed(shingles[order] ^ _MIX[0]))])
        ends = np.cumsum(counts)
        content = sums[ends[signed]] - sums[ends[signed] - counts[signed]]
        keys = (np.uint64(blocks) << np.uint64(32)) + signed.astype(np.uint64)
        out.append(_mixed(content + _mixed(keys)))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _described(docs: DataFrame, rule: Rule) -> DataFrame:
    """(doc_id, hash of the text, set size, set signature, block signatures) of every row, written."""

    @F.pandas_udf("n long, node long, blocks array<long>")
    def describe(texts: pd.Series) -> pd.DataFrame:
        sets = [shingle_set(t, rule.words) for t in texts]
        return pd.DataFrame({
            "n": [len(s) for s in sets],
            "node": np.array([xxhash.xxh64_intdigest(s.tobytes(), seed=len(s)) for s in sets], np.uint64).view(np.int64),
            "blocks": [_signed(block_signatures(s, rule)) for s in sets]})

    rows = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("text_hash"), describe(text_or_empty()).alias("d"))
    return stored(rows.select("doc_id", "text_hash", "d.n", "d.node", "d.blocks"), "jaccard-sets", batch=TEXT_BATCH)


def _candidates(described: DataFrame) -> DataFrame:
    """Candidate edges (a, b) between sets (node, blocks) that share a block, enough to connect all that do.

    Blocks are dealt out in rounds by their signature, so that the shuffle of one round is on disk at a time.
    """
    rounds = min(ROUNDS, max(1, -(-bytes_in_files(described) // ROUND_BYTES)))
    return reduce(DataFrame.union, [stored(_round(described, k, rounds), "jaccard-ties") for k in range(rounds)])


def _round(described: DataFrame, k: int, rounds: int) -> DataFrame:
    """The candidate edges of the blocks of round ``k``."""

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # One row per distinct block of some thousand sets, with its smallest set; the other sets
        # of that block are tied to it here.
        for batch in batches:
            for at in range(0, len(batch), BLOCK_SETS):
                rows = batch[at:at + BLOCK_SETS].drop_duplicates("node")
                counts = rows["blocks"].map(len).to_numpy()
                if not counts.sum():
                    continue
                block = np.concatenate(rows["blocks"].to_numpy()).astype(np.int64)
                node = np.repeat(rows["node"].to_numpy(), counts)
                if rounds > 1:
                    own = block.view(np.uint64) % np.uint64(rounds) == k
                    block, node = block[own], node[own]
                    if not len(block):
                        continue
                order = np.lexsort((node, block))
                block, node = block[order], node[order]
                first = np.concatenate([[True], block[1:] != block[:-1]])
                head = node[first][np.cumsum(first) - 1]
                differ = ~first & (head != node)
                yield pd.DataFrame({"block": block[first], "node": node[first], "other": node[first]})
                pairs = pd.DataFrame({"block": 0, "node": node[differ], "other": head[differ]}).drop_duplicates()
                pairs["block"] = _signed(_mixed(pairs["node"].to_numpy().view(np.uint64)))
                yield pairs

    def ties(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Rows come sorted by block: each is tied to the first of its block.
        held_block, held = None, None
        for rows in batches:
            found = rows[rows["node"] != rows["other"]]
            yield found[["node", "other"]].rename(columns={"node": "a", "other": "b"}).drop_duplicates()
            rows = rows[rows["node"] == rows["other"]]
            if not len(rows):
                continue
            block, node = rows["block"].to_numpy(), rows["node"].to_numpy()
            first = np.concatenate([[block[0] != held_block], block[1:] != block[:-1]])
            starts = np.concatenate([[held if held is not None else 0], node[first]])
            head = starts[np.cumsum(first)]
            held_block, held = block[-1], head[-1]
            differ = ~first & (head != node)
            yield pd.DataFrame({"a": node[differ], "b": head[differ]}).drop_duplicates()

    shared = described.where("size(blocks) > 0").select("node", "blocks").mapInPandas(
        local, "block long, node long, other long")
    partitions = int(described.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return shared.repartition(partitions, "block").sortWithinPartitions("block", "node").mapInPandas(
        ties, "a long, b long").distinct()


class Region:
    """Shingle sets of one task, ready to be counted against one another."""

    def __init__(self, texts, rule: Rule):
        sets = [shingle_set(t, rule.words) for t in texts]
        self.rule, self.n = rule, np.array([len(s) for s in sets], dtype=np.int64)
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        del sets
        # numbers below the region's count of shingles, which a task's memory keeps below 2^31
        dense = np.unique(flat, return_inverse=True)[1].astype(np.int32)
        self.ends = np.cumsum(self.n)
        self.starts = self.ends - self.n
        self.dense = dense
        self.mark = np.zeros(int(dense.max()) + 1 if len(dense) else 1, dtype=bool)

    def shared(self, i: int) -> np.ndarray:
        """How many shingles set i shares with every set."""
        own = self.dense[self.starts[i]:self.ends[i]]
        self.mark[own] = True
        counts = np.add.reduceat(self.mark[self.dense].view(np.uint8), self.starts, dtype=np.int64)
        self.mark[own] = False
        return counts

    def linked(self, i: int) -> np.ndarray:
        return self.rule.linked(self.shared(i), self.n[i], self.n)

    def part(self, index: np.ndarray) -> Region:
        """The region of some of these sets."""
        out = object.__new__(Region)
        out.rule, out.n, out.mark = self.rule, self.n[index], self.mark
        out.dense = np.concatenate([self.dense[self.starts[i]:self.ends[i]] for i in index])
        out.ends = np.cumsum(out.n)
        out.starts = out.ends - out.n
        return out


def cells_around(distances: np.ndarray, open_: np.ndarray, eps: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """(members, seeds) of the Voronoi cells around pivots, from each set's distances to the pivots.

    A cell's seeds are the open sets nearest to its pivot; its members are all sets that may be within
    ``eps`` of a seed by the triangle inequality.
    """
    near = distances.argmin(axis=1)
    own = distances[np.arange(len(near)), near]
    out = []
    for p in range(distances.shape[1]):
        seeds = open_ & (near == p)
        if seeds.any():
            d = distances[:, p]
            members = (d >= own[seeds].min() - eps) & (d <= own[seeds].max() + eps) & (d <= own + 2 * eps)
            out.append((np.flatnonzero(members), seeds[members]))
    return out


@dataclass
class Work:
    """What a region's join did: links found by pivots, and by comparing sets one by one; sets compared; cells made."""

    by_pivots: int = 0
    one_by_one: int = 0
    compared: int = 0
    cells: int = 0


def join_in_task(whole: Region, seeds: np.ndarray, sets: Sets, work: Work, main: int | None = None) -> None:
    """Ties in ``sets`` every linked pair of a region with a seed in it that its components need.

    Sets of one component, that of ``main``, need not meet each other, so they are seeds no more; every other seed stays
    one until it joins it.  Where all sets are seeds, that is the largest component that the first pivots found.  It stays
    the same for all parts: were it chosen anew, a seed of it and a set that is no seed might never meet.

    A region is parted into cells only where that leaves fewer comparisons than one by one, and each of them
    at most three quarters of its sets.  The shingles of one part at a time are held next to the whole region's.
    """
    todo = [(np.arange(len(whole.n)), seeds)]
    while todo:
        names, seeds = todo.pop()
        if sets.groups == 1:
            return
        n = len(names)
        region = whole if n == len(whole.n) else whole.part(names)

        def tie(i: int, found: np.ndarray) -> int:
            before = sets.groups
            for j in found:
                sets.join(int(names[i]), int(names[j]))
            work.compared += n
            return before - sets.groups

        cells: list[tuple[np.ndarray, np.ndarray]] = []
        if n > DIRECT:
            # pivots far from each other, the first one by its hash
            distances, pivot = [], 0
            for _ in range(LEAF_PIVOTS):
                both = region.shared(pivot)
                distances.append(1 - both / (region.n + region.n[pivot] - both))
                work.by_pivots += tie(pivot, np.flatnonzero(region.rule.linked(both, region.n[pivot], region.n)))
                pivot = int(np.min(distances, axis=0).argmax())
            colours = np.array([sets.root(int(i)) for i in names])
            if main is None and seeds.all():
                found, counts = np.unique(colours, return_counts=True)
                main = int(found[counts.argmax()])
            if main is not None:
                seeds = seeds & (colours != sets.root(main))
            cells = cells_around(np.stack(distances, axis=1), seeds, region.rule.eps + 1e-9)
            cost = sum((int(own.sum()) + LEAF_PIVOTS) * len(members) for members, own in cells)
            if cost >= n * int(seeds.sum()) or any(4 * len(members) > 3 * n for members, _ in cells):
                cells = []  # distances do not spread
        if cells:
            work.cells += len(cells)
            todo += [(names[members], own) for members, own in cells]
            continue
        for i in np.flatnonzero(seeds):
            if main is None or sets.root(int(names[i])) != sets.root(main):
                work.one_by_one += tie(i, np.flatnonzero(region.linked(i)))
            if sets.groups == 1:
                return


def _leaf(rule: Rule):
    """All links of a small region that matter for its components, as (a, b) to each component's smallest set."""

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("node").sort_values("node", ignore_index=True)
        sets, core = Sets(len(rows)), np.flatnonzero(rows["core"].to_numpy(bool))
        for i in core:
            sets.join(int(core[0]), int(i))
        join_in_task(Region(rows["text"], rule), rows["seed"].to_numpy(bool), sets, Work(), int(core[0]) if len(core) else None)
        node = rows["node"].to_numpy()
        roots = np.array([sets.root(i) for i in range(len(rows))], dtype=np.int64)
        tied = roots != np.arange(len(rows))
        return pd.DataFrame({"a": node[tied], "b": node[roots[tied]]})

    return join


def _pivot_distances(rule: Rule):
    """Distances of a chunk's sets to the region's pivots, and which pivots they link to."""

    def measure(rows: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        pivots = pivots.drop_duplicates("pivot").sort_values("pivot", ignore_index=True)
        rows = rows.drop_duplicates("node")
        if not len(rows) or not len(pivots):
            return pd.DataFrame({"region": [], "node": [], "seed": [], "near": [], "distances": [], "links": []})
        k = len(pivots)
        region = Region([*pivots["text"], *rows["text"]], rule)
        shared = np.stack([region.shared(i)[k:] for i in range(k)], axis=1)
        n = region.n[k:, None]
        distances = 1 - shared / (n + region.n[None, :k] - shared)
        names = pivots["pivot"].to_numpy()
        linked = rule.linked(shared, n, region.n[None, :k])
        return pd.DataFrame({
            "region": rows["region"].to_numpy(), "node": rows["node"].to_numpy(), "seed": rows["seed"].to_numpy(),
            "near": distances.argmin(axis=1), "distances": list(distances), "links": [names[m] for m in linked]})

    return measure


def _chunk_links(rule: Rule):
    """Links between a chunk of seeds and a chunk of members."""

    def meet(seeds: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        if not len(seeds) or not len(members):
            return pd.DataFrame({"a": [], "b": []})
        k = len(seeds)
        region, sets = Region([*seeds["text"], *members["text"]], rule), Sets(k + len(members))
        for i in range(k):
            for j in k + np.flatnonzero(region.linked(i)[k:]):
                sets.join(i, int(j))
        node = np.concatenate([seeds["node"].to_numpy(), members["node"].to_numpy()])
        roots = np.array([sets.root(i) for i in range(len(node))], dtype=np.int64)
        tied = node[roots] != node
        return pd.DataFrame({"a": node[tied], "b": node[roots[tied]]})

    return meet


def _in_chunks(size, name: str):
    return F.pmod(F.xxhash64("node", F.lit(name)), F.greatest(F.lit(1), F.ceil(size / CHUNK))).cast("int")


def _renewed(df: DataFrame) -> DataFrame:
    """``df`` under new column identities, so that two sides of one origin can be told apart."""
    return df.toDF(*df.columns)


def _chunk_by_chunk(large: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """Links between the seeds and the members of regions (region, node, seed, members, seeds), a pair of chunks a task."""
    n_seeds, n_members = F.greatest(F.lit(1), F.ceil(F.col("seeds") / CHUNK)), F.ceil(F.col("members") / CHUNK)
    one = large.where("seed").withColumn("i", _in_chunks(F.col("seeds"), "s")).withColumn(
        "j", F.explode(F.sequence(F.lit(0), (n_members - 1).cast("int"))))
    other = large.withColumn("j", _in_chunks(F.col("members"), "m")).withColumn(
        "i", F.explode(F.sequence(F.lit(0), (n_seeds - 1).cast("int"))))
    return one.join(texts, "node").groupBy("region", "i", "j").cogroup(
        _renewed(other.join(texts, "node")).groupBy("region", "i", "j")).applyInPandas(_chunk_links(rule), "a long, b long")


def _frequent(rule: Rule):
    """The shingles that at least ``least`` sets of a piece of a family hold, with their counts."""

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        sets = [shingle_set(t, rule.words) for t in rows["text"]]
        shingle, held = np.unique(np.concatenate(sets), return_counts=True)
        many = held >= rows["least"].iloc[0]
        return pd.DataFrame({"family": rows["family"].iloc[0], "shingle": _signed(shingle[many]), "held": held[many]})

    return count


def _rarer_blocks(rule: Rule):
    """Block signatures of the sets of a piece of a family, by the shingles that are not in the family's frequent ones."""

    def sign(rows: pd.DataFrame, frequent: pd.DataFrame) -> pd.DataFrame:
        lists = [np.asarray(x, dtype=np.int64) for x in frequent["frequent"]]
        common = np.unique(np.concatenate(lists).view(np.uint64)) if lists else np.zeros(0, np.uint64)
        blocks = []
        for text in rows["text"]:
            shingles = shingle_set(text, rule.words)
            blocks.append(_signed(block_signatures(shingles, rule, ~np.isin(shingles, common, assume_unique=True))))
        return pd.DataFrame({"node": rows["node"].to_numpy(), "blocks": blocks})

    return sign


def _without_frequent(texts: DataFrame, rule: Rule) -> DataFrame:
    """Candidate edges inside large families (node, family, text), by their blocks of rarer content.

    Shingles that many sets of a family hold (a passage that thousands of documents quote) do not count
    when the blocks to sign are chosen, so blocks of such shingles alone are signed only by sets that have
    little else.  Any choice of frequent shingles finds all links, if it is the same for a whole family.

    A family is dealt into pieces of ``PIECE`` bytes of text.  Each piece counts its shingles in its task and
    hands on those that may be frequent in the family; a family's frequent ones are one array.  They are in more
    than ``1 / (4 * SHARE)`` of its sets, so there are at most ``4 * SHARE`` times as many as an average set holds.
    """
    sizes = stored(texts.groupBy("family").agg(
        F.count(F.lit(1)).alias("members"), F.sum(F.octet_length("text").cast("long")).alias("bytes")), "family-bytes")
    need = F.greatest(F.lit(LEAF // 2), F.ceil(F.col("members") / SHARE))
    pieces = F.ceil(F.col("bytes") / PIECE).cast("int")
    sizes = sizes.select("family", pieces.alias("pieces"), need.alias("need"),
                         F.greatest(F.lit(2), F.floor(need / pieces)).alias("least"))
    dealt = texts.join(small(sizes), "family").withColumn(
        "piece", F.pmod(F.xxhash64("node", F.lit("p")), F.col("pieces")).cast("int"))
    counted = dealt.groupBy("family", "piece").applyInPandas(_frequent(rule), "family long, shingle long, held long")
    frequent = counted.groupBy("family", "shingle").agg(F.sum("held").alias("held")).join(small(sizes), "family").where(
        F.col("held") * 4 >= F.col("need"))
    arrays = stored(frequent.groupBy("family", "pieces").agg(F.collect_list("shingle").alias("frequent")), "family-frequent")
    per_piece = arrays.select("family", "frequent", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    signed = dealt.groupBy("family", "piece").cogroup(_renewed(per_piece).groupBy("family", "piece")).applyInPandas(
        _rarer_blocks(rule), "node long, blocks array<long>")
    return _candidates(stored(signed, "family-blocks"))


def _join_large(regions: DataFrame, texts: DataFrame, rule: Rule, known: DataFrame, depth: int) -> DataFrame:
    """Links of regions (region, node, seed, core); ``known`` are links found before.

    Core sets are those of the component whose sets need not meet each other.
    """
    sizes = small(stored(regions.groupBy("region").agg(F.count(F.lit(1)).alias("members"), F.sum(
        F.col("seed").cast("long")).alias("seeds")), "region-sizes"))
    sized = regions.join(sizes, "region")
    with_text = lambda df: df.join(texts, "node")
    little = with_text(sized.where(F.col("members") <= LEAF)).groupBy("region").applyInPandas(_leaf(rule), "a long, b long")
    large = stored(sized.where((F.col("members") > LEAF) & (F.col("seeds") > 0)), "regions-large")
    if large.isEmpty():
        return stored(little, "region-links")
    if depth == 0:
        return stored(little.union(_chunk_by_chunk(large, texts, rule)), "region-links")
    # About four times PIVOTS seeds are drawn by hash, and PIVOTS of them kept: a bounded number per region.
    draw = F.pmod(F.xxhash64("node", F.lit(depth)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    drawn = large.where("seed").where(draw < F.lit(4.0 * PIVOTS) / F.col("seeds")).groupBy("region").agg(
        F.slice(F.array_sort(F.collect_set("node")), 1, PIVOTS).alias("pivots"), F.first("members").alias("members"))
    pivots = drawn.select("region", "members", F.explode("pivots").alias("node")).join(texts, "node").select(
        "region", F.col("node").alias("pivot"), "text",
        F.explode(F.sequence(F.lit(0), (F.ceil(F.col("members") / CHUNK) - 1).cast("int"))).alias("chunk"))
    rows = with_text(large.withColumn("chunk", _in_chunks(F.col("members"), "m")))
    core = stored(large.where("core").select("region", F.col("node").alias("core")), "region-core")
    measured = stored(
        rows.groupBy("region", "chunk").cogroup(_renewed(pivots).groupBy("region", "chunk")).applyInPandas(
            _pivot_distances(rule),
            "region string, node long, seed boolean, near int, distances array<double>, links array<long>"), "region-distances")
    links = stored(
        little.union(measured.select(F.col("node").alias("a"), F.explode("links").alias("b"))).union(known).distinct(),
        "region-links")
    found = components(links)
    coloured = stored(measured.join(small(found), F.col("node") == F.col("a"), "left").withColumn(
        "colour", F.coalesce("b", "node")).drop("a", "b", "links"), "region-colours")
    counts = coloured.groupBy("region", "colour").agg(F.count(F.lit(1)).alias("c"), F.min("seed").alias("only_seeds"))
    largest = counts.groupBy("region").agg(
        F.max_by("colour", F.struct("c", "colour")).alias("largest"), F.count(F.lit(1)).alias("colours"),
        F.min("only_seeds").alias("only_seeds"))
    # known core sets share a component; the first time, where all sets are seeds, the largest becomes the core
    held = core.join(small(found), F.col("core") == F.col("a"), "left").groupBy(F.col("region").alias("r")).agg(
        F.max(F.coalesce("b", "core")).alias("held"))
    main = small(stored(largest.join(held, F.col("region") == F.col("r"), "left").select(
        "region", "colours", F.coalesce("held", F.when(F.col("only_seeds"), F.col("largest"))).alias("main")), "region-main"))
    in_core = F.coalesce(F.col("colour") == F.col("main"), F.lit(False))
    open_ = stored(coloured.join(main, "region").where("colours > 1").withColumn("core", in_core).withColumn(
        "seed", F.col("seed") & ~F.col("core")), "regions-open")
    own = F.element_at("distances", F.col("near") + 1)
    windows = small(stored(open_.where("seed").groupBy("region", "near").agg(
        F.min(own).alias("lo"), F.max(own).alias("hi")).withColumnsRenamed({"region": "r", "near": "cell"}), "region-windows"))
    eps = F.lit(rule.eps + 1e-9)
    d = F.col("distances")[F.col("cell")]
    cells = open_.join(windows, F.col("region") == F.col("r")).where(
        (d >= F.col("lo") - eps) & (d <= F.col("hi") + eps) & (d <= own + 2 * eps))
    nested = stored(cells.select(
        F.concat_ws("/", "region", F.col("cell").cast("string")).alias("region"), "node",
        (F.col("seed") & (F.col("near") == F.col("cell"))).alias("seed"), "core"), "regions")
    replicas = nested.count()
    if not replicas:
        return links
    if replicas > REPLICAS * open_.count():
        # distances do not spread: the windows hold nearly everything
        again = open_.select("region", "node", "seed")
        counts = small(stored(again.groupBy("region").agg(F.count(F.lit(1)).alias("members"), F.sum(
            F.col("seed").cast("long")).alias("seeds")), "region-sizes"))
        return links.union(stored(_chunk_by_chunk(again.join(counts, "region"), texts, rule), "region-links"))
    return links.union(_join_large(nested, texts, rule, links, depth - 1))


def jaccard_classes(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id) of every row of ``docs``."""
    return _classes(docs, rule).drop("_one")


def _classes(docs: DataFrame, rule: Rule) -> DataFrame:
    """Also _one: (doc_id is null, doc_id, text_hash) of the row that stands for its component; null without words."""
    described = _described(docs, rule)
    slim = stored(described.select("doc_id", "text_hash", "n", "node"), "jaccard-rows")
    # A family is named by its smallest set; (a, b): set and family.  Sets without shingles have no blocks.
    tied = components(_candidates(described))
    discard(described)  # the block signatures are by far the largest table
    families = stored(tied.union(tied.select("b", "b").distinct()).toDF("node", "family"), "families")
    one_row = F.struct(F.col("doc_id").isNull().alias("u"), "doc_id", "text_hash")
    classes = stored(slim.where("n > 0").groupBy("node").agg(F.min(one_row).alias("row")), "jaccard-classes")
    sizes = small(stored(families.groupBy("family").agg(F.count(F.lit(1)).alias("members")), "family-sizes"))
    members = stored(families.join(classes, "node").join(sizes, "family").select(
        "node", "family", "members", F.col("row.doc_id").alias("_id"), F.col("row.text_hash").alias("_hash")), "family-members")
    hashed = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("text_hash"), text_or_empty().alias("text"))
    if not is_small(members):  # most texts are in no family: they are not shuffled
        hashed, _ = screened(hashed, F.col("text_hash"), members, "_hash")
    texts = hashed.join(small(members), F.col("doc_id").eqNullSafe(F.col("_id")) & (
        F.col("text_hash") == F.col("_hash"))).select("node", "family", "members", "text")
    repeated = slim.where("n > 0").groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    if not repeated.isEmpty():  # rows of one id and text are one row per task before they are shuffled
        texts = texts.dropDuplicates(["node"])
    texts = stored(texts, "family-texts")
    large = texts.where(F.col("members") > LEAF)
    leaves = texts.where(F.col("members") <= LEAF).withColumns({"seed": F.lit(True), "core": F.lit(False)})
    roots = stored(leaves.groupBy("family").applyInPandas(_leaf(rule), "a long, b long"), "family-links", batch=None)
    if not large.isEmpty():
        finer = components(_without_frequent(large.select("node", "family", "text"), rule))
        finer = finer.union(finer.select("b", "b").distinct())
        regions = finer.select(F.col("b").cast("string").alias("region"), F.col("a").alias("node"), F.lit(True).alias("seed"),
                                F.lit(False).alias("core"))
        found = _join_large(regions, large.select("node", "text"), rule, roots.limit(0), DEPTH)
        roots = roots.union(components(found))
    labelled = classes.join(small(stored(roots, "jaccard-roots")), F.col("node") == F.col("a"), "left").select(
        "node", F.coalesce("b", "node").alias("root"), "row")
    named = labelled.groupBy("root").agg(F.min("row").alias("_one"))
    ids = stored(labelled.select("node", "root").join(named, "root").select(
        F.col("node").alias("_node"), "_one"), "jaccard-ids")
    joined = slim.join(ids, (F.col("node") == F.col("_node")) & (F.col("n") > 0), "left")
    return joined.select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("_one.doc_id")).otherwise(F.col("doc_id")).alias("component_id"), "_one")


def one_of_each(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each linked group does: the one with the smallest id.

    Ids come before none, equal ids (or none) go by the hash of the text.  Rows without words are groups of their own.
    Of rows with the same id and text, all stay or none (exact copies are another operator's task).
    """
    classes = _classes(docs, rule).where(F.col("_one").isNotNull()).where(
        ~(F.col("doc_id").eqNullSafe(F.col("_one.doc_id")) & (F.col("text_hash") == F.col("_one.text_hash")))).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    dropped = stored(classes, "jaccard-dropped")
    hashed = F.xxhash64(text_or_empty())
    remaining = lambda rows: rows.join(
        small(dropped), F.col("doc_id").eqNullSafe(F.col("_id")) & (hashed == F.col("_hash")), "left_anti")
    if is_small(dropped):
        return remaining(docs)
    some, others = screened(docs, hashed, dropped, "_hash")
    return remaining(some).union(others)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(documents(spark, sf_dir).select("doc_id", "text"), CONTRACT).drop("text_hash")
