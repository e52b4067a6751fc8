"""Alignment, coverage and spans of licence findings against brute force; toxicity features by hand."""

import math
import random

import pytest

from domainpulse.llm import license_scan as ls
from domainpulse.llm import toxicity


def longest_common(x, y):
    row = [0] * (len(y) + 1)
    for a in x:
        old = 0
        for j, b in enumerate(y):
            old, row[j + 1] = row[j + 1], old + 1 if a == b else max(row[j + 1], row[j])
    return row[-1]


def noisy(words, rnd, drop, add):
    out = []
    for w in words:
        if rnd.random() >= drop:
            out.append(w)
        if rnd.random() < add:
            out.append(rnd.choice(["zebra", "the", "of", f"n{rnd.randrange(99)}"]))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_alignment_against_the_longest_common_subsequence(seed):
    rnd = random.Random(seed)
    for t in rnd.sample([t for t in ls.templates() if len(t.words) < 400], 12):
        x = noisy(t.words, rnd, 0.12, 0.08)
        pairs = ls.align(x, t.words)
        assert all(x[i] == t.words[j] for i, j in pairs)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(pairs, pairs[1:]))
        best = longest_common(x, t.words)
        assert best * 0.9 <= len(pairs) <= best  # anchors may cost a few words of the optimum, never invent one


def brute_findings(words, t):
    """(coverage, start, stop) of a template that stands once in a text: the best part by longest common subsequence."""
    best = longest_common(words, t.words)
    return best / len(t.words)


@pytest.mark.parametrize("seed", range(4))
def test_coverage_and_spans_of_planted_licences(seed):
    """Planted texts are found where they stand, with the coverage that brute force gives, and nothing else is."""
    rnd = random.Random(seed)
    filler = lambda n: [f"plain{rnd.randrange(10**6)}" for _ in range(n)]
    names = ["MIT", "ISC", "BSD-3-Clause", "GPL-3.0", "Unlicense", "Zlib"]
    for name in [n for n in names if n in ls.TEXTS]:
        (t,) = [x for x in ls.templates() if x.license == name and x.kind == "text" and x.words == ls.template(name, "text", ls.TEXTS[name], 0.8).words]
        keep = [w for j, w in enumerate(t.words) if j in t.named or rnd.random() >= 0.05]
        before, after = filler(40), filler(40)
        found = ls.scan(" ".join([*before, *keep, *after]), ls.templates())
        same = [f for f in found if f["license"] == name]
        assert len(found) == len(same) == 1
        f = same[0]
        assert f["start"] >= 40 and f["stop"] <= 40 + len(keep) and f["stop"] - f["start"] >= 0.9 * len(keep)
        if f["coverage"] < 1 and f["kind"] == "text" and len(ls.MORE_TEXTS.get(name, [])) == 0:
            assert f["coverage"] == pytest.approx(brute_findings(keep, t), abs=0.03)
    assert ls.scan(" ".join(filler(500)), ls.templates()) == []


def test_features_by_hand():
    lexicon = toxicity.Lexicon({"vile": 3.0}, {"nast": 2.0})
    text = "You are a VILE vile NASTY loser!! st*pid i d i o t heeeey?"
    got = toxicity.features(text, lexicon, {})
    words = ["you", "are", "a", "vile", "vile", "nasty", "loser", "st", "pid", "i", "d", "i", "o", "t", "heeeey"]
    n = len(words)
    assert len(got) == toxicity.N_FEATURES
    assert got[0] == math.log1p(n) and got[1] == 3 / n and got[3] == (3 + 3 + 2) / n and got[4] == 3
    assert got[5] == 1 / n and got[7] == 1 / n and got[8] == 4 / n and got[9] == 1.0
    letters = sum(c.isalpha() for c in text)
    assert got[10] == sum(c.isupper() for c in text) / letters and got[11] == 2 / n
    assert got[12] == 2 / n and got[13] == 1 / n and got[14] == 1 / n
    assert got[17] == 1 / n and got[18] == 1 / n
    assert toxicity.features("", lexicon, {}) == toxicity.features(" .,! ", lexicon, {}) == [0.0] * toxicity.N_FEATURES


def test_trees_on_odd_rows(spark):
    """The fitted path on nulls, empty and very long texts, repeated rows and clashing columns; no row is lost."""
    rnd = random.Random(3)
    bad = ["you are a stupid idiot", "pathetic losers like you", "shut up you moron"]
    good = ["the river runs by the old town", "they read books in the evening", "a quiet morning with tea"]
    rows = [(i, f"{rnd.choice(bad if i % 3 == 0 else good)} {i % 17}") for i in range(400)]
    odd = [(None, "you idiot"), (1000, None), (1001, ""), (1002, " \t"), (1003, "word " * 30_000), (0, rows[0][1]), (0, rows[0][1])]
    docs = spark.createDataFrame([(*r, "x", 1.0) for r in rows + odd], "doc_id long, text string, held_out string, score double")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(400)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    assert model.trees is not None
    out = toxicity.score_documents(docs, labels).collect()
    assert len(out) == len(rows) + len(odd) and all(0 <= r["score"] <= 1 for r in out)
    by_text = {}
    for r in out:
        by_text.setdefault(r["text"], set()).add(r["score"])
    assert all(len(s) == 1 for s in by_text.values())  # a score hangs on the text alone
    held = [r for r in out if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 400]
    right = sum(r["predicted"] == int(r["doc_id"] % 3 == 0) for r in held)
    assert len(held) > 40 and right >= 0.95 * len(held)
