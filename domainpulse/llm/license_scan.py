"""Licence scan by patience alignment.

A document is cut into normalised words.  For each template whose words it
holds in sufficient number (a count over its vocabulary, exact: a template
cannot reach its coverage without it), stretches around the template's words
are aligned with it: words that stand once in both are anchors, the longest
increasing run of anchors is kept, and the gaps between kept anchors are
aligned in the same way; a gap without such words is matched from its ends
and then word by word in order.  Coverage is the share of the template's
words that are aligned.

Every place where a template reaches its coverage, and where the words that
name its licence and version align, is a finding: the document is cut where template words stop for more than ``GAP`` words, and each
stretch is aligned by itself.

Defined results: null and empty texts have no findings; a document may have
several, also of one licence; of overlapping findings the best covered stays,
by aligned less missing words; repeated rows are scanned each; an empty table gives no
rows; input columns named like the added one are replaced.  All work is in
one pass without a shuffle; only the templates (fixed, small) are shipped.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domainpulse.llm.common import TEXT_BATCH, documents, stored, text_or_empty, without
from domainpulse.llm.licence_texts import MORE_TEXTS, NOTICES, OTHERS, TEXTS

#: Share of a template's words that must align, for short lines and for texts; words between stretches.
NOTICE_COVERAGE, TEXT_COVERAGE, GAP = 0.7, 0.8, 12
#: Other words that may stand between the words of a short line.
SLACK = 2
ADDED = ("licenses",)
WORDS = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")
FINDING = "array<struct<license:string,kind:string,coverage:double,start:int,stop:int>>"


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


@dataclass(frozen=True)
class Template:
    license: str
    kind: str
    words: tuple[str, ...]
    coverage: float
    #: Places of the words that name the licence and its version: these must align.
    named: frozenset[int] = frozenset()

    @property
    def needed(self) -> int:
        """How many of its words must align."""
        return -(-int(self.coverage * 100) * len(self.words) // 100)


def template(license: str, kind: str, text: str, coverage: float) -> Template:
    """The template of a text in which a star stands before each word that must align."""
    marked = [(m[0], m.start() > 0 and text[m.start() - 1] == "*") for m in WORDS.finditer(text)]
    return Template(license, kind, tuple(w.lower() for w, _ in marked), coverage,
                    frozenset(j for j, (_, star) in enumerate(marked) if star))


def templates() -> list[Template]:
    short = [template(k, "notice", t, NOTICE_COVERAGE) for k, ts in NOTICES.items() for t in ts]
    long = [*TEXTS.items(), *((k, t) for k, ts in MORE_TEXTS.items() for t in ts)]
    return short + [template(k, "text", t, TEXT_COVERAGE) for k, t in long]


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, sorted by their first, that rises in the second (patience sorting)."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tops, j)
        back.append(piles[at - 1] if at else -1)
        if at == len(tops):
            tops.append(j)
            piles.append(k)
        else:
            tops[at], piles[at] = j, k
    out, k = [], piles[-1] if piles else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(x: list[str], y: tuple[str, ...] | list[str]) -> list[tuple[int, int]]:
    """Aligned places (i, j) with x[i] == y[j], rising in both; gaps are worked off from a stack."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and x[a] == y[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and x[b - 1] == y[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a >= b or c >= d:
            continue
        in_x, in_y = Counter(x[a:b]), Counter(y[c:d])
        place = {w: j for j, w in enumerate(y[c:d], c) if in_y[w] == 1}
        anchors = _rising([(i, place[w]) for i, w in enumerate(x[a:b], a) if in_x[w] == 1 and w in place])
        if anchors:
            edges = [(a - 1, c - 1), *anchors, (b, d)]
            found += anchors
            todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:])]
            continue
        # no word stands once in both: words in order, each at its first place left
        j = c
        for i in range(a, b):
            if in_y.get(x[i]):
                k = next((k for k in range(j, d) if y[k] == x[i]), None)
                if k is not None:
                    found.append((i, k))
                    j = k + 1
    return sorted(found)


def _stretches(words: list[str], template: Template) -> list[tuple[int, int]]:
    """Parts of the document in which the template's words never stop for more than ``GAP`` words."""
    own = set(template.words)
    out: list[tuple[int, int]] = []
    for i, w in enumerate(words):
        if w in own:
            if out and i - out[-1][1] <= GAP:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((i, i + 1))
    return out


def _windows(part: list[str], template: Template) -> list[tuple[int, int]]:
    """Starts and ends inside a stretch to align.

    A short line is looked for close around each place of its rarest word there, as it must stand
    together.  For a text, it is the whole stretch and, if that is much longer than the template,
    also a wide window around each such place.
    """
    n, short = len(template.words), template.kind == "notice"
    if not short and len(part) <= 2 * n:
        return [(0, len(part))]
    counts = Counter(part)
    wanted = {template.words[j] for j in template.named} or set(template.words)
    rare = min((w for w in wanted if counts[w]), key=lambda w: (counts[w], w), default=None)
    if rare is None:
        return []
    at = template.words.index(rare)
    reach = (lambda k: k + SLACK) if short else (lambda k: 2 * k + GAP)
    around = {(max(0, i - reach(at)), min(len(part), i + reach(n - at))) for i, w in enumerate(part) if w == rare}
    return sorted(around if short else around | {(0, len(part))})


def scan(text: str, wanted: list[Template]) -> list[dict]:
    words = words_of(text)
    vocabulary = set(words)
    found: list[tuple] = []
    for t in wanted:
        if len(words) < t.needed or not all(t.words[j] in vocabulary for j in t.named):
            continue
        if sum(w in vocabulary for w in t.words) < t.needed:
            continue
        others = (OTHERS & vocabulary).difference(t.words)
        for start, stop in _stretches(words, t):
            part = words[start:stop]
            if len(part) < t.needed:
                continue
            for a, b in _windows(part, t):
                pairs = align(part[a:b], t.words)
                if len(pairs) >= t.needed and t.named <= {j for _, j in pairs}:
                    i, j = pairs[0][0], pairs[-1][0]
                    # a short line must stand together, but for a few words in between
                    if t.kind == "notice" and j - i + 1 > len(t.words) + SLACK:
                        continue
                    if others and not others.isdisjoint(part[a + i:a + j + 1]):
                        continue
                    found.append((t.license, t.kind, len(pairs) / len(t.words), start + a + i, start + a + j + 1,
                                  2 * len(pairs) - len(t.words)))
    best: list[tuple] = []
    for f in sorted(found, key=lambda f: (-f[5], -f[2], f[3] - f[4], f[3], f[0])):
        if not any(f[3] < g[4] and g[3] < f[4] for g in best):
            best.append(f)
    return [dict(zip(("license", "kind", "coverage", "start", "stop"), f)) for f in sorted(best, key=lambda f: (f[3], f[0]))]


def scan_licenses(docs: DataFrame, wanted: list[Template] | None = None) -> DataFrame:
    """``docs`` with ``licenses``: license, kind, coverage and the words [start, stop) of every finding."""
    wanted = wanted or templates()
    find = F.pandas_udf(lambda texts: pd.Series([scan(t, wanted) for t in texts], dtype=object), FINDING)
    return without(docs, *ADDED).withColumn("licenses", find(text_or_empty()))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan_licenses(documents(spark, sf_dir).select("doc_id", "text"))
    best = F.array_max(F.transform("licenses", lambda x: x["coverage"]))
    return stored(
        scanned.select("doc_id", F.size("licenses").alias("n_licenses"), best.alias("coverage"), "licenses"),
        "license-findings", batch=TEXT_BATCH)
