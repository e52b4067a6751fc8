"""Filter audit, vector codes and the language model against plain Python, on odd rows and hot groups."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF001
from domainpulse.llm import filter_audit, maxent_lm, vector_codes
from oracle_harness import compare, duck

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_vector_codes"])
def test_against_sql(spark, name):
    res = compare(spark, duck(SF001), name, entry.queries()[name], entry.oracle_sql()[name], SF001)
    assert res["ok"], res


# --- filter audit ---------------------------------------------------------
def words_of(text):
    return (text or "").encode().split()


def failures(rows, labels):
    """(part, failed letters, good, toxic) of each row, in plain Python."""
    least = {}
    for doc, text, _ in rows:
        if doc is not None:
            least[text or ""] = min(doc, least.get(text or "", doc))
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    for doc, text, lang in rows:
        text, w = text or "", words_of(text)
        fails = "".join(f for f, c in (
            ("A", len(w) < 100), ("B", 100 * len(set(w)) < 80 * len(w)),
            ("C", 100 * sum("A" <= x <= "Z" for x in text) > 10 * len(text)), ("D", any(x in "#$%&*|" for x in text)),
            ("E", doc is not None and doc > least[text])) if c)
        yield lang or "", fails, doc is not None and doc in good, doc is not None and doc in toxic


def brute_audit(rows, labels):
    found, out = list(failures(rows, labels)), {}
    for part in {p for p, *_ in found}:
        mine, shapley = [x[1:] for x in found if x[0] == part], Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, own in enumerate(order, 1):
                before = set(order[:step - 1])
                here = [(f, g, t) for f, g, t in mine if own in f and not before & set(f)]
                shapley[own] += len(here)
                out[part, order, step] = [
                    sum(not (before | {own}) & set(f) for f, *_ in mine), len(here),
                    sum(own in f and bool(before & set(f)) for f, *_ in mine), sum(f == own for f, *_ in mine),
                    sum(g for _, g, _ in here), sum(t for *_, t in here), own]
        for key, row in out.items():
            if key[0] == part:
                row[-1] = shapley[row[-1]]
    return out


def collected(df):
    return {(r["part"], r["filter_order"], r["step"]): [
        r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for r in df.collect()}


def audit_rows():
    rnd = random.Random(5)
    vocabulary = ["alpha", "Beta", "GAMMA", "delta#", "eps%ilon", *[f"w{i}" for i in range(300)]]
    rows = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([3, 99, 100, 160]))), rnd.choice(["en", "de", None, ""])) for i in range(60)]
    rows += [(200 + i, rows[i % 3][1], rnd.choice(["en", "de"])) for i in range(120)]  # three texts hold most rows
    rows += [(7, rows[7][1], "en"), (7, rows[7][1], "en"), (7, "another text of one id", "fr")]  # repeated rows and ids
    rows += [(None, rows[0][1], "en"), (None, None, None), (400, None, "en"), (401, "", "en"), (402, " \t\r\n", "en"), (3000, "ÄÖÜ ABC", "de")]
    rows.append((500, "long " * 40_000, "en"))
    return rows


def test_audit_against_plain_python(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "SALT_BYTES", 2000)  # the hot texts are dealt over many salts
    rows = audit_rows()
    labels = [(i, i % 2, (i // 2) % 2) for i in range(0, 400, 3)] + [(0, 0, 1), (3, None, None), (None, 1, 1), (9999, 1, 1)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, mask string, hash long")
    got = collected(filter_audit.audit(filter_audit.combinations(
        docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))))
    assert got == brute_audit(rows, labels) and len(got) == 600 * 4


def test_audit_of_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(filter_audit.combinations(docs, labels)).count() == 0
    one = spark.createDataFrame([(1, "a", None, None, None)], DOCS)
    rows = collected(filter_audit.audit(filter_audit.combinations(one, labels)))
    assert len(rows) == 600 and rows["", "ABCDE", 1] == [0, 1, 0, 1, 0, 0, 120] and rows["", "EABCD", 1][0] == 1


def test_audit_stays_in_the_jvm(spark):
    docs = spark.createDataFrame(audit_rows(), "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    plan = filter_audit.audit(filter_audit.combinations(docs, labels))._jdf.queryExecution().executedPlan().toString()
    assert not [n for n in ("Python", "Pandas", "CartesianProduct", "NestedLoop") if n in plan]


# --- vector codes -----------------------------------------------------------
def brute_codes(rows, parts=16, entries=64, rounds=2):
    """rows: (vec_id, vector, label), kept ones of one length; codes, errors and codebooks in Python's integers."""
    whole = lambda x: (lambda n, d: n * 256 // d)(*float(x).as_integer_ratio())
    kept = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ints = [[whole(x) for x in v] for _, v, _ in kept]
    width = len(ints[0]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for v in ints]
    books = [[cut[e][p] for e in range(min(entries, len(cut)))] for p in range(parts)]

    def nearest(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(e, x)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for v in cut:
                held[nearest(books[p], v[p])[1]].append(v[p])
            for e, members in held.items():
                books[p][e] = [sum(c) // len(members) for c in zip(*members)]
    out = []
    for (vec, _, label), v in zip(kept, cut):
        found = [nearest(books[p], v[p]) for p in range(parts)]
        out.append((vec, "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found), label))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    total = Counter()
    for _, _, e, label in out:
        total[label] += e
    return sorted((str(vec), code, e, total[label], digest) for vec, code, e, label in out)


def query_over(spark, scratch, rows, schema="vec_id long, embedding array<double>, label int"):
    spark.createDataFrame(rows, schema).write.parquet(f"{scratch}/embeddings.parquet")
    out = vector_codes.op12_vector_codes(spark, scratch)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in out.collect())


def test_codes_against_plain_python_with_odd_rows(spark, scratch):
    rnd = random.Random(3)
    vec = lambda: [rnd.choice([rnd.gauss(0, 1), rnd.randint(-3, 3) / 2]) for _ in range(32)]
    rows = [(i, vec(), rnd.choice([None, 1, 2])) for i in range(150)]
    rows += [(200 + i, rows[5][1], 1) for i in range(90)]  # one vector of more than a third of all rows
    rows += [(3, vec(), 1), (3, vec(), 1), (None, vec(), 2), (None, [0.0] * 32, None)]  # repeated and null ids
    bad = [(900, None, 1), (901, [], 1), (902, [1.0] * 31 + [None], 1), (903, [math.nan] * 32, 1), (904, [math.inf] * 32, 1),
           (905, [1.0] * 16, 1), (906, [1.0] * 20, 1)]
    got = query_over(spark, scratch, rows + bad)
    assert got == brute_codes(rows)


@pytest.mark.parametrize("n", [1, 5, 64])
def test_codes_of_few_rows(spark, scratch, n):
    rnd = random.Random(n)
    rows = [(i, [float(rnd.randint(-9, 9)) for _ in range(16)], None) for i in range(n)]
    assert query_over(spark, scratch, rows) == brute_codes(rows)


def test_codes_of_huge_components_are_exact(spark, scratch):
    rows = [(i, [(-1.0) ** i * 1e6 * (i + j) + 0.3 for j in range(16)], i % 2) for i in range(70)]
    rows += [(100, [2.0 ** 60] * 16, 7)]  # its sums fit no 64 bits
    want = [(v, c, e if e < 1 << 63 else None, t if t < 1 << 63 else None, d) for v, c, e, t, d in brute_codes(rows)]
    assert query_over(spark, scratch, rows) == want


def test_codes_of_an_empty_table(spark, scratch):
    assert query_over(spark, scratch, []) == []


def test_sums_of_many_tasks_are_added_level_by_level(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "FAN_IN", 2)
    rnd = random.Random(1)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(16)], 0) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(11)
    coded, books = vector_codes.compress(df)
    want = brute_codes(rows)
    assert books.digest() == want[0][-1]
    assert sorted((str(r["vec_id"]), r["code"]) for r in coded.collect()) == [w[:2] for w in want]


def test_orchard_search_equals_brute_force_and_skips_distances():
    rnd = np.random.default_rng(0)
    for ties in (False, True):
        entries = rnd.integers(-3, 4, (64, 3)) if ties else rnd.integers(-500, 500, (64, 4))
        queries = rnd.integers(-4, 5, (3000, 3)) if ties else np.concatenate(
            [entries[rnd.integers(0, 64, 1500)] + rnd.integers(-20, 21, (1500, 4)), rnd.integers(-500, 500, (1500, 4))])
        code, near, computed = vector_codes.Neighbours(entries).search(queries)
        every = ((queries[:, None, :] - entries[None]) ** 2).sum(-1)
        assert (code == every.argmin(1)).all() and (near == every.min(1)).all()
        if not ties:
            assert computed < 0.7 * every.size


# --- language model -----------------------------------------------------------
def lm_docs(n=260, seed=2):
    """Texts in which the next word hangs on the one before."""
    rnd = random.Random(seed)
    follow = {f"w{i}": [f"w{(7 * i + j) % 40}" for j in range(3)] for i in range(40)}
    rows = []
    for i in range(n):
        w, out = f"w{rnd.randint(0, 39)}", []
        for _ in range(rnd.randint(1, 120)):
            out.append(w.upper() if rnd.random() < 0.1 else w)
            w = rnd.choice(follow[w])
        if rnd.random() < 0.5:
            out.append(f"rare{i}")
        rows.append((i, " ".join(out)))
    return rows


def fold(doc):
    return None if doc is None else zlib.crc32(str(doc).encode()) % 5


def words_and_end(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in "".join(" " if c in "\t\n\x0b\x0c\r " else c for c in lowered).split(" ") if w] + [None]


def check_base(rows, got):
    counts = Counter(w for d, t in rows if fold(d) not in (None, 1) for w in words_and_end(t))
    n, v = sum(counts.values()), len(counts)
    want = []
    for d, t in rows:
        words = words_and_end(t)
        want.append((repr(d), fold(d) in (None, 1), len(words), sum(w in counts for w in words), n,
                     round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words), 6)))
    assert sorted((repr(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
                  for r in got) == sorted(want)


def test_lm_base_counts_and_held_out_gain(spark):
    rows = lm_docs()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = maxent_lm.score_documents(docs).collect()
    check_base(rows, got)
    held = [r for r in got if r["held_out"]]
    gain = sum(r["score"] - r["base_score"] for r in held) / sum(r["n_tokens"] for r in held)
    assert len(held) > 30 and gain > 0.1
    assert all(r["score"] <= 0 for r in got)


def test_lm_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(maxent_lm, "HELD_WORDS", 5)  # counts are handed on many times
    monkeypatch.setattr(maxent_lm, "BATCH", 16)
    rows = lm_docs(60) + [(None, "w1 w2"), (None, None), (5, None), (5, ""), (6, " \t\x0b\r\n"), (7, "w1\x0bW2\x0cÉÀ w3"), (8, "x" * 50_000),
                          (9, "w1 " * 30_000), (3, "w1 w2"), (3, "w1 w2")] + [(10, "same text here")] * 40
    docs = spark.createDataFrame([(*r, "s", 1.0) for r in rows], "doc_id long, text string, row string, score double")
    check_base(rows, maxent_lm.score_documents(docs).collect())


def test_lm_without_training_rows_or_rows(spark):
    schema = "doc_id long, text string"
    assert maxent_lm.score_documents(spark.createDataFrame([], schema)).count() == 0
    held = [i for i in range(60) if fold(i) == 1][:4]
    got = maxent_lm.score_documents(spark.createDataFrame([(i, "a b") for i in held], schema)).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got] == [(3, 0, 0, 0.0)] * 4
    assert all(r["score"] < 0 for r in got)


def test_lm_probabilities_of_all_members_sum_to_one():
    words = sorted(((f"w{i}".encode(), 3000 - 40 * i) for i in range(60)), key=lambda w: -w[1])
    vocabulary = maxent_lm.Vocabulary(words, 100_000, 5000, {t: (20, 7) for t in range(0, maxent_lm.TAILS, 2)})
    rnd = np.random.default_rng(1)
    tables = maxent_lm.Tables(vocabulary, (
        rnd.normal(0, 1, (maxent_lm.CLASS_ROWS, vocabulary.classes)).astype(np.float32),
        rnd.normal(0, 1, (maxent_lm.MEMBER_ROWS, vocabulary.width)).astype(np.float32)))
    features = rnd.integers(0, 1 << 60, (4, 1)).astype(np.uint64)
    every = np.arange(vocabulary.members)
    total = np.exp(tables.log_probabilities(every, np.repeat(features, len(every), axis=1))).sum()
    assert total == pytest.approx(1.0, abs=1e-4)
    # inside a tail group: the known words' shares and the share of new words
    size = 10 ** vocabulary.tail_size[0]
    assert 20 / size + 10 ** vocabulary.tail_new[0] / size == pytest.approx(1.0)


def test_lm_changes_are_averaged_by_tokens_level_by_level(spark, monkeypatch):
    monkeypatch.setattr(maxent_lm, "FAN_IN", 2)
    monkeypatch.setattr(maxent_lm, "TASK_TOKENS", 500)
    rows = lm_docs(200)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    got = maxent_lm.score_documents(docs).collect()
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] - r["base_score"] for r in held) > 0


def test_lm_score_is_that_of_the_tables_and_counts(spark):
    """Each document's score again, from the trained tables and the counts, word by word."""
    rows = lm_docs(80)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = maxent_lm.fit_language_model(docs.where(~maxent_lm.held_out()))
    counts = {bytes(r["word"]): r["n"] for r in model.counts.collect()}
    v = model.tables.vocabulary
    for r in model.score(docs).where("doc_id % 9 = 0").collect():
        words = maxent_lm.tokens(dict(rows)[r["doc_id"]])
        member = np.array([v.number([w])[1][0] for w in words])
        features = maxent_lm.context_features(member, np.arange(len(words)) == 0)
        total = model.tables.log_probabilities(member, features).sum() / math.log(10)
        for w in words:
            if v.index.get(w, v.heads) >= v.heads:
                group = maxent_lm.tail_groups_of([w])[0]
                size = v.tail_tokens[group] + v.tail_words[group]
                total += math.log10((counts.get(w) or v.tail_words[group] or 1) / (size or 1))
        assert r["score"] == pytest.approx(total, abs=1e-3)


def test_lm_tail_groups_agree_between_the_engines(spark):
    words = [b"a", b"ab", b"xab", "é".encode(), "aé".encode(), b"\n", b"longword"]
    df = spark.createDataFrame([(w,) for w in words], "word binary")
    got = [r[0] for r in df.select(maxent_lm.tail_groups()).collect()]
    assert got == maxent_lm.tail_groups_of(words).tolist()
    assert F is not None
