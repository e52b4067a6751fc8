"""run() over a fixture with nulls, repeated rows and hot groups, against plain Python, given the fitted toxicity scores."""

import hashlib
import random
from collections import Counter

import pytest

import corpus_pipeline
from conftest import SF001
from domainpulse.llm import byte_bpe, mixing, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def fixture_rows(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rnd = random.Random(12)
    words = [f"w{i}" for i in range(400)]
    hot = [rnd.choice(words) for _ in range(60)]
    out = list(rows)
    for i in range(120):  # a hot group of near copies
        near = list(hot)
        near[rnd.randrange(60)] = f"new{i % 40}"
        out.append((50_000 + i, " ".join(near), "en", "hot", 1))
    out += [(60_000 + i, "exact  copies\tof one text", "en", "hot", 1) for i in range(80)]
    out += [(60_500, " exact copies\nof one   text  ", None, None, None)]
    out += [(None, None, None, None, None), (None, "a text without id " + " ".join(words[:30]), "en", "x", 1), (70_000, None, "en", "x", 1),
            (70_001, "", "en", "x", 0), (70_002, "word " * 20_000, "en", "x", 1), (70_003, " ".join(words[:35]), "de", "x", 1)]
    return out


def exact(rows):
    groups = {}
    for r in rows:
        groups.setdefault("".join(c for c in r[1] or "" if c not in " \t\n\x0b\x0c\r"), []).append(r)
    return [min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0)) for g in groups.values()]


def shingles(text, n=5):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + min(n, len(w))]) for i in range(len(w) - min(n, len(w)) + 1)) if w else frozenset()


def near(rows):
    sets, up = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 5 * min(len(sets[i]), len(sets[j])) >= 4 * max(len(sets[i]), len(sets[j])):
                both = len(sets[i] & sets[j])
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    up[root(i)] = root(j)
    best = {}
    for i, r in enumerate(rows):
        key = root(i) if sets[i] else ("none", i)
        best[key] = min(best.get(key, r), r, key=lambda r: (r[0] is None, r[0] or 0))
    return list(best.values())


def mixed(rows):
    sizes = [len((r[1] or "").encode().split()) for r in rows]
    total = Counter()
    for r, n in zip(rows, sizes):
        total[r[3]] += n
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    targets, open_ = {}, set(order)
    while open_:
        left, shared = sum(sizes) - sum(targets.values()), sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / shared > 3 * total[s]}
        if not over:
            targets |= {s: left * weight[s] / shared for s in open_}
            break
        targets |= {s: 3.0 * total[s] for s in over}
        open_ -= over
    out = []
    for r in rows:
        rate = targets[r[3]] / total[r[3]] if total[r[3]] else 0.0
        key = str(r[0]) if r[0] is not None else "text:" + hashlib.md5((r[1] or "").encode()).hexdigest()
        draw = int(hashlib.md5(f"mix:{key}".encode()).hexdigest()[:13], 16) / 2 ** 52
        out += [r] * (int(rate) + (draw < rate - int(rate)))
    return out


def test_run_against_plain_python(spark, scratch):
    rows = fixture_rows(spark)
    docs = spark.createDataFrame(rows, DOCS)
    docs.write.parquet(f"{scratch}/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    labels.write.parquet(f"{scratch}/labels.parquet")
    stored = spark.read.parquet(f"{scratch}/documents.parquet")
    model = toxicity.fit_toxicity(stored, labels.select("doc_id", "toxic"))
    scores = {(r["doc_id"], r["text"]): r["score"] for r in model.score(stored).collect()}
    clean = [r for r in rows if scores[r[0], r[1]] < toxicity.THRESHOLD]
    want = mixed(near(exact(clean)))
    got = corpus_pipeline.run(spark, scratch).collect()
    import tiktoken  # noqa: F401  the encoder that the digests stand for

    digests = {(r["doc_id"], r["decoded_sha256"]) for r in got}
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in want)
    assert digests == {(r[0], hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in want}
    alone = byte_bpe.digests(spark.createDataFrame(want, DOCS)).collect()
    assert Counter(map(repr, alone)) == Counter(map(repr, got))
    assert 0 < len(near(exact(clean))) < len(exact(clean)) < len(clean)


def test_run_on_an_empty_table(spark, scratch):
    spark.createDataFrame([], DOCS).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    assert corpus_pipeline.run(spark, scratch).count() == 0


@pytest.mark.parametrize("column", ["score", "kept", "component_id", "copies", "size"])
def test_run_keeps_to_columns_of_clashing_names(spark, scratch, column):
    rows = [(i, f"text number {i} " + "word " * i, "en", "s", 1, "x") for i in range(30)]
    spark.createDataFrame(rows, DOCS + f", {column} string").write.parquet(f"{scratch}/documents.parquet")
    spark.read.parquet(f"{SF001}/labels.parquet").limit(0).write.parquet(f"{scratch}/labels.parquet")
    assert corpus_pipeline.run(spark, scratch).count() > 0
