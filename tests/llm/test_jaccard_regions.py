"""Pivots, Voronoi cells and windows against all pairs, in a task and over tables; families of frequent shingles."""

import collections
import random

import numpy as np
import pytest

from domainpulse.llm import jaccard
from domainpulse.llm.components import Sets


DONE: list = []


def chains(rnd, groups=6, length=14, words=60):
    """Texts that drift a word at a time, so that links chain far beyond one pivot's reach."""
    out = []
    for g in range(groups):
        text = [f"g{g}w{rnd.randrange(40)}" for _ in range(words)]
        for _ in range(length):
            out.append(" ".join(text))
            text = list(text)
            for _ in range(rnd.choice([1, 1, 2])):
                text[rnd.randrange(words)] = f"x{rnd.randrange(10**6)}"
    rnd.shuffle(out)
    return out


def classes_by_pairs(sets, rule):
    up = list(range(len(sets)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if x and sets[j] and rule.linked(both, len(x), len(sets[j])):
                up[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(sets))]


@pytest.mark.parametrize("seed", range(12))
def test_cells_in_a_task_lose_no_link(seed, monkeypatch):
    rnd = random.Random(seed)
    monkeypatch.setattr(jaccard, "DIRECT", rnd.choice([2, 4, 9]))
    monkeypatch.setattr(jaccard, "LEAF_PIVOTS", rnd.choice([1, 2, 4]))
    rule = rnd.choice([jaccard.Rule(), jaccard.CONTRACT, jaccard.Rule(words=2, num=60)])
    texts = chains(rnd)
    sets, work = Sets(len(texts)), jaccard.Work()
    jaccard.join_in_task(jaccard.Region(texts, rule), np.ones(len(texts), bool), sets, work)
    want = classes_by_pairs([set(jaccard.shingle_set(t, rule.words).tolist()) for t in texts], rule)
    assert [sets.root(i) for i in range(len(texts))] == want
    DONE.append(work)


def test_cells_and_pivots_did_the_work():
    assert sum(w.by_pivots for w in DONE) > 0 and sum(w.cells for w in DONE) > 0 or not DONE


def test_parting_never_costs_much_more_than_comparing_one_by_one(monkeypatch):
    """Sets that no window parts: long unrelated texts, tied by a passage; the work stays near that of all pairs."""
    rnd = random.Random(4)
    common = " ".join(f"c{i}" for i in range(30))
    texts = [common + " " + " ".join(f"w{rnd.randrange(10**6)}" for _ in range(rnd.randint(30, 90))) for _ in range(300)]
    sets, work = Sets(len(texts)), jaccard.Work()
    jaccard.join_in_task(jaccard.Region(texts, jaccard.Rule()), np.ones(len(texts), bool), sets, work)
    assert work.compared <= 1.2 * 300 * 300 and sets.groups == 300


def test_pivots_find_the_links_of_a_family_of_near_copies():
    """A large group of near copies: a few pivots tie nearly all, and few sets are compared one by one."""
    rnd = random.Random(1)
    hot = [f"w{rnd.randrange(300)}" for _ in range(120)]
    texts = []
    for _ in range(400):
        own = list(hot)
        own[rnd.randrange(120)] = f"n{rnd.randrange(10**6)}"
        texts.append(" ".join(own))
    rule = jaccard.Rule()
    sets, work = Sets(len(texts)), jaccard.Work()
    jaccard.join_in_task(jaccard.Region(texts, rule), np.ones(len(texts), bool), sets, work)
    assert sets.groups == 1 and work.one_by_one == 0 and work.compared <= 4 * len(texts)


def test_windows_hold_every_set_within_reach():
    rnd = np.random.default_rng(3)
    points = rnd.random((300, 2))
    apart = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    open_ = rnd.random(300) < 0.4
    cells = jaccard.cells_around(apart[:, :7], open_, 0.1)
    met = {(int(members[s]), int(m)) for members, own in cells for s in np.flatnonzero(own) for m in members}
    assert all((i, j) in met for i in np.flatnonzero(open_) for j in np.flatnonzero(apart[i] <= 0.1))
    assert sum(len(m) for m, _ in cells) < 0.9 * 7 * 300


@pytest.mark.parametrize("seed", range(2))
def test_rounds_over_tables_lose_no_link(spark, monkeypatch, seed):
    """Regions of a few sets, parted over two rounds of pivots; one core component is kept through them."""
    rnd = random.Random(100 + seed)
    monkeypatch.setattr(jaccard, "LEAF", 6)
    monkeypatch.setattr(jaccard, "DIRECT", 2)
    monkeypatch.setattr(jaccard, "CHUNK", 16)
    monkeypatch.setattr(jaccard, "PIVOTS", 2)
    monkeypatch.setattr(jaccard, "REPLICAS", 50)
    rule = jaccard.Rule()
    boilerplate = " ".join(f"common{i}" for i in range(30))  # ties all texts into one family
    texts = [f"{t} {boilerplate}" for t in chains(rnd, groups=5, length=9)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_classes(docs, rule).collect()}
    want = classes_by_pairs([set(jaccard.shingle_set(t, rule.words).tolist()) for t in texts], rule)
    assert got == dict(enumerate(want))


def test_frequent_shingles_of_a_family_over_pieces(spark, monkeypatch):
    """A passage that all sets quote: the family is dealt into pieces, and its links are those of all pairs."""
    monkeypatch.setattr(jaccard, "LEAF", 20)
    monkeypatch.setattr(jaccard, "PIECE", 4000)
    rnd = random.Random(5)
    passage = [f"quoted{i}" for i in range(25)]
    rows = []
    for i in range(150):
        own = [f"o{i // 2}x{k}" for k in range(20)]  # pairs of near copies
        if i % 2:
            own[rnd.randrange(20)] = f"changed{i}"
        rows.append((i, " ".join(own + passage)))
    rows += [(1000 + i, rows[0][1]) for i in range(100)]  # and one text of two fifths of all rows
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    rule = jaccard.Rule()
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_classes(docs, rule).collect()}
    want = classes_by_pairs([set(jaccard.shingle_set(t, rule.words).tolist()) for _, t in rows], rule)
    assert got == {d: rows[w][0] for (d, _), w in zip(rows, want)}
    assert max(collections.Counter(got.values()).values()) >= 101


def test_a_row_repeated_in_a_leaf(spark):
    rows = [(1, "one two three four five six")] * 50 + [(None, "one two three four five six")] * 50 + [(2, "one two three four five six seven"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter((r["doc_id"], r["component_id"]) for r in jaccard.jaccard_classes(docs, jaccard.Rule(words=2)).collect())
    assert got == {(1, 1): 50, (None, 1): 50, (2, 1): 1, (3, 3): 1}
