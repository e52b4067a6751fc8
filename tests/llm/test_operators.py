"""The training-data operators: brute force, SQL, hot groups, and odd rows."""

import collections
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF001
from domainpulse.llm import components, embedding_dedup, exact_dedup, jaccard, license_scan, mixing, sharding, suffix_dedup, toxicity
from oracle_harness import compare, duck

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", ["op1_sharding", "op3_exact_dedup", "op8_embedding_dedup", "op10_mixing"])
def test_against_sql(spark, name):
    res = compare(spark, duck(SF001), name, entry.queries()[name], entry.oracle_sql()[name], SF001)
    assert res["ok"], res


def odd_docs(spark):
    rows = [(1, "a b c", "en", "s", 1), (1, "a b c", "en", "s", 1), (2, None, None, None, None), (None, "a b c", None, "s", 1),
            (3, "", "", "", 0), (4, " \t", "x", "s", 2), (5, "long " * 30_000, "en", None, 3), (None, None, None, None, None)]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS + ", size string, score int")


def test_odd_rows_and_empty_tables(spark, scratch):
    docs = odd_docs(spark)
    path = f"{scratch}/docs"
    docs.write.parquet(path)
    rows = exact_dedup.exact_dedup(spark, path).collect()
    assert len(rows) == 8 and sum(r["kept"] for r in rows) == 3  # blanks, "abc", the long text
    assert {r["keep_id"] for r in rows if r["text"] is None or not r["text"].strip()} == {4}
    clashing = docs.withColumnsRenamed({"size": "row", "score": "kept"})
    kept = exact_dedup.kept_rows(clashing)
    assert kept.columns == clashing.columns
    assert {(r["doc_id"], r["row"], r["kept"]) for r in kept.collect()} == {(4, "x", 1), (1, "x", 1), (5, "x", 1)}
    sharded = sharding.shard_by_bytes(docs, 4).collect()
    assert sorted(collections.Counter(r["shard"] for r in sharded).values()) and len(sharded) == 8
    for s in range(4):
        slots = sorted(r["slot"] for r in sharded if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert mixing.plan_mix(docs).count() == 8 and mixing.mixed(docs).columns == docs.columns
    classes = jaccard.jaccard_classes(docs).collect()
    assert sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in classes if r["n_shingles"] == 1) == [
        (0, 1, 1), (1, 1, 1), (1, 1, 1), (5, 1, 5)]
    assert jaccard.one_of_each(docs).columns == docs.columns
    assert suffix_dedup.repeated_passages(docs).agg(F.sum("repeated_words")).first()[0] == 0
    assert license_scan.scan_licenses(docs).where("size(licenses) > 0").count() == 0
    labels = spark.createDataFrame([(1, 1), (None, 0)], "doc_id long, toxic int")
    assert toxicity.score_documents(docs, labels).where("score between 0 and 1").count() == 8
    clean = toxicity.ToxicityModel(None, None, None, 0.1).keep_clean(docs)
    assert clean.columns == docs.columns and clean.count() == 8
    assert toxicity.ToxicityModel(None, None, None, 0.9).keep_clean(docs).count() == 0
    none = docs.limit(0)
    none.write.parquet(f"{scratch}/none")
    assert exact_dedup.exact_dedup(spark, f"{scratch}/none").count() == 0
    for out in (sharding.shard_by_bytes(none), mixing.plan_mix(none), jaccard.jaccard_classes(none),
                suffix_dedup.repeated_passages(none), license_scan.scan_licenses(none)):
        assert out.count() == 0


def test_digests_that_collide_are_told_apart_by_their_bytes(spark, scratch):
    docs = spark.createDataFrame([(i, f"text {i % 7}") for i in range(40)], "doc_id long, text string")
    docs.write.parquet(f"{scratch}/d")
    weak = lambda c: F.substring(F.sha2(c, 256), 1, 1)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.exact_dedup(
        spark, f"{scratch}/d", digest=weak).collect()}
    assert got == {i: (i % 7, len(range(i % 7, 40, 7))) for i in range(40)}


def test_stream_state_goes_on_with_new_files(spark, scratch):
    path, state = f"{scratch}/d", f"{scratch}/state"
    spark.createDataFrame([(2, "a"), (3, "b")], "doc_id long, text string").write.parquet(path)
    exact_dedup.exact_dedup(spark, path, state)
    spark.createDataFrame([(1, "a "), (4, "c")], "doc_id long, text string").write.mode("append").parquet(path)
    got = {r["doc_id"]: r["keep_id"] for r in exact_dedup.exact_dedup(spark, path, state).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_stream_state_takes_new_files_with_old_times(spark, scratch):
    path, state = f"{scratch}/d", f"{scratch}/state"
    spark.createDataFrame([(2, "a"), (3, "b")], "doc_id long, text string").write.parquet(path)
    exact_dedup.exact_dedup(spark, path, state)
    before = set(os.listdir(path))
    spark.createDataFrame([(1, "a "), (4, "b")], "doc_id long, text string").write.mode("append").parquet(path)
    for name in set(os.listdir(path)) - before:
        os.utime(f"{path}/{name}", (1_000_000_000, 1_000_000_000))
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.exact_dedup(spark, path, state).collect()}
    assert got == {1: (1, 2), 2: (1, 2), 3: (3, 2), 4: (3, 2)}


def brute_components(sets, rule):
    up = {k: k for k in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and rule.linked(both, len(sets[a]), len(sets[b])):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {k: root(k) for k in keys}


@pytest.mark.parametrize("rule", [jaccard.Rule(), jaccard.CONTRACT])
def test_jaccard_regions_against_all_pairs(spark, rule, monkeypatch):
    # a small LEAF sends the hot group and the shared passage through every kind of region
    monkeypatch.setattr(jaccard, "LEAF", 12)
    monkeypatch.setattr(jaccard, "CHUNK", 8)
    monkeypatch.setattr(jaccard, "PIVOTS", 3)
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    base, passage = [r.choice(vocabulary) for _ in range(90)], [r.choice(vocabulary) for _ in range(40)]
    rows = []
    for i in range(120):
        if i % 3 == 0:
            words = list(base)
            for _ in range(r.randint(0, 6)):
                words[r.randrange(len(words))] = r.choice(vocabulary)
        else:
            words = [r.choice(vocabulary) for _ in range(r.randint(1, 80))] + (passage if i % 3 == 1 else [])
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {k: set(jaccard.shingle_set(t, rule.words).tolist()) for k, t in rows}
    want = brute_components(sets, rule)
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in jaccard.jaccard_classes(docs, rule).collect()}
    assert got == {k: (len(sets[k]), want[k]) for k in want}


def test_one_of_each_with_null_and_repeated_ids(spark):
    groups = [[f"g{g}w{i}" for i in range(60)] for g in range(4)]
    near = lambda g, k: " ".join([*groups[g], f"end{k}"])
    rows = [(None, near(0, 0)), (None, near(0, 1)), (5, near(0, 2)), (4, near(0, 3)),  # ids and none
            (None, near(1, 0)), (None, near(1, 1)), (None, near(1, 2)),  # no id at all
            (7, near(2, 0)), (7, near(2, 1)), (7, near(2, 2)),  # one id
            (8, near(3, 0)), (8, near(3, 0).upper()), (9, "alone"), (9, None), (None, " "), (None, "apart")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in jaccard.one_of_each(docs).collect()]
    of = lambda g: [k for k, t in kept if t and t.lower().startswith(f"g{g}w")]
    assert [of(g) for g in range(4)] == [[4], [None], [7], [8]]
    assert sorted((k or 0, t or "") for k, t in kept if not (t or "").lower().startswith("g")) == [
        (0, " "), (0, "apart"), (9, ""), (9, "alone")]


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r["a"]: r["b"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 50)}}


def test_embeddings_in_chunks_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CHUNK", 7)
    g = np.random.default_rng(3)
    base = g.standard_normal((8, 20))
    x = np.concatenate([base[g.integers(0, 8, 90)] + 0.04 * g.standard_normal((90, 20)), g.standard_normal((30, 20))])
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(200, x[0].tolist()), (201, [0.0] * 20), (202, None), (203, []),
                                                        (204, [float("nan")] * 20), (205, [1e200] * 20), (206, [1e-200] * 20)]
    got = {r["vec_id"]: tuple(r)[1:] for r in embedding_dedup.embedding_classes(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    y = np.concatenate([x, x[:1], np.ones((2, 20))])
    ids = [*range(120), 200, 205, 206]
    y = y / np.linalg.norm(y, axis=1, keepdims=True)
    near = y @ y.T >= 0.95
    np.fill_diagonal(near, False)
    label = np.array(ids)
    while True:
        new = np.array([min([label[i], *label[near[i]]]) for i in range(len(ids))])
        if (new == label).all():
            break
        label = new
    for i, k in enumerate(ids):
        assert got[k] == (near[i].sum(), label[i], label[i] == k)
    for k in (201, 202, 203, 204):
        assert got[k] == (0, k, True)


def test_repeated_passages_against_all_windows(spark):
    r = random.Random(9)
    fresh = lambda n: [f"{r.randrange(10**9)}" for _ in range(n)]
    passages = [fresh(n) for n in (50, 55, 60, 80, 49)]
    rows = [(i, " ".join(fresh(r.randint(0, 30)) + passages[i % 5] + fresh(r.randint(0, 30)))) for i in range(60)]
    rows += [(100, " ".join(fresh(70) * 2)), (101, None), (102, "short")]
    got = {x["doc_id"]: x for x in suffix_dedup.repeated_passages(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        want = len(passages[i % 5]) if i < 60 and i % 5 != 4 else 0
        assert got[i]["repeated_words"] == want, i
        assert all(s["other_id"] != i for s in got[i]["spans"])


def test_passages_around_a_shorter_hot_run(spark):
    r = random.Random(21)
    fresh = lambda n: [f"{r.randrange(10**9)}" for _ in range(n)]
    rows = []
    for size in range(41, 50):
        hot = fresh(size)
        rows += [fresh(r.randint(10, 20)) + hot + fresh(r.randint(10, 20)) for _ in range(30)]
        for length in (50, 51, 54, 58, 62, 70):
            left = r.randint(0, length - size)
            shared = fresh(left) + hot + fresh(length - size - left)
            rows += [fresh(r.randint(5, 20)) + shared + fresh(r.randint(5, 20)) for _ in range(2)]
    twice = fresh(55)
    rows += [twice + fresh(20) + twice + fresh(9), fresh(7) + twice + fresh(30)]
    windows = [[tuple(x[i:i + 50]) for i in range(len(x) - 49)] for x in rows]
    held = collections.Counter(w for x in windows for w in set(x))
    want = {k: len({j for i, w in enumerate(x) if held[w] > 1 for j in range(i, i + 50)}) for k, x in enumerate(windows)}
    r.shuffle(order := list(enumerate(rows)))
    docs = spark.createDataFrame([(k, " ".join(x)) for k, x in order], "doc_id long, text string").repartition(7)
    got = {x["doc_id"]: x["repeated_words"] for x in suffix_dedup.repeated_passages(docs).collect()}
    assert got == want


def test_alignment_rises_and_covers():
    t = license_scan.TEXTS["ISC"]
    words = license_scan.words_of(t)
    noisy = [w for i, w in enumerate(words) if i % 11] + ["end"]
    pairs = license_scan.align(noisy, words)
    assert all(noisy[i] == words[j] for i, j in pairs)
    assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(pairs, pairs[1:]))
    assert len(pairs) == len(noisy) - 1
    found = license_scan.scan("lead words here. " + " ".join(noisy), license_scan.templates())
    assert [f["license"] for f in found] == ["ISC"]
    assert license_scan.scan("a licence is granted under some terms", license_scan.templates()) == []


@pytest.mark.parametrize("line, license", [
    ("Licensed under the Apache License 2.0", "Apache-2.0"), ("Released under the Apache License, Version 2.0", "Apache-2.0"),
    ("Licensed under the BSD 3-Clause License", "BSD-3-Clause"), ("licensed under BSD 2-Clause License", "BSD-2-Clause"),
    ("SPDX-License-Identifier: GPL-3.0-or-later", "GPL-3.0"), ("SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0"),
    ("SPDX-License-Identifier: AGPL-3.0-or-later", "AGPL-3.0"), ("under the MIT License", "MIT"),
    ("Released under the GNU Lesser General Public License version 3", "LGPL-3.0"),
    ("Released under the GNU General Public License, version 2", "GPL-2.0"),
    ("licensed under the GNU Affero General Public License v3", "AGPL-3.0"), ("Released under the GPLv3", "GPL-3.0"),
    ("Licensed under the GNU General Public License v3.0", "GPL-3.0"), ("Released under CC BY-NC-SA 4.0", "CC-BY-NC-SA-4.0"),
    ("Licensed under the Apache License 1.1", None), ("the license of the Apache foundation, version 2.0", None),
    ("Licensed under CC BY 3.0", None), ("released under the license", None)])
def test_reworded_licence_lines(line, license):
    found = license_scan.scan(f"Some words stand before. {line}. Other words follow it here.", license_scan.templates())
    assert {f["license"] for f in found} == ({license} if license else set())


def test_licence_bodies_and_headers_are_told_apart():
    def found(text):
        return [f["license"] for f in license_scan.scan(f"words before it {text} and words after", license_scan.templates())]

    gpl = license_scan.TEXTS["GPL-3.0"]
    for version in ("2", "2.1", "3"):
        for name, family in (("", "GPL"), ("Lesser ", "LGPL"), ("Affero ", "AGPL")):
            license = f"{family}-{version if '.' in version else version + '.0'}"
            if license in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0"):
                assert found(gpl.replace("*3 of", f"{version} of").replace("General", f"{name}General")) == [license]
    for license, texts in license_scan.MORE_TEXTS.items():
        for text in texts:
            words = text.split()
            assert found(" ".join(w for i, w in enumerate(words) if i % 29 or w[0] == "*")) == [license], license
            assert found(text) == [license], license
    assert found(license_scan.TEXTS["MIT"]) == ["MIT"] and found(gpl.replace("*3 of", "9 of")) == []


def test_license_query_against_the_lines_in_the_texts(spark):
    lines = ["Licensed under CC BY-NC 4.0", "This work is licensed under the GNU General Public License, version 3",
             "Licensed under the Apache License, Version 2.0", "Released under the MIT License"]
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = license_scan.op6_license_scan(spark, SF001).collect()
    assert {r["doc_id"]: r["n_licenses"] for r in rows} == {k: sum(t.count(x) for x in lines) for k, t in texts.items()}


def test_toxicity_on_the_held_out_fold(spark):
    scored = toxicity.op7_toxicity(spark, SF001)
    labels = spark.read.parquet(f"{SF001}/labels.parquet").where("toxic is not null").dropDuplicates(["doc_id"])
    r = scored.join(labels, "doc_id").where("held_out").agg(
        F.avg((F.col("predicted") == F.col("toxic")).cast("int")).alias("right"), F.count(F.lit(1)).alias("n")).first()
    assert r["n"] > 30 and r["right"] >= 0.9
    assert scored.where("score is null or score < 0 or score > 1").count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        assert out.columns == columns, name
        if name != "mixing":
            assert out.join(docs, "doc_id", "left_anti").isEmpty() and out.count() <= docs.count()
        docs = out
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF001).count() == docs.count()
