"""Targets against their iterative definition; taken words near the targets, also where rows share ids."""

import collections
import random

from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF001
from domainpulse.llm import mixing


def iterative_targets(sizes, weights=mixing.WEIGHTS, limit=mixing.LIMIT):
    """Share by weight; stop sources at their caps and share their excess among the rest, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, targets, open_ = float(sum(sizes.values())), {}, set(order)
    while open_:
        left, shared = total - sum(targets.values()), sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / shared > limit * sizes[s]}
        if not over:
            return targets | {s: left * w[s] / shared for s in open_}
        targets |= {s: float(limit * sizes[s]) for s in over}
        open_ -= over
    return targets


def test_targets_follow_their_definition(spark):
    for seed in range(4):
        rnd = random.Random(seed)
        sizes = {s: rnd.choice([0, 1, 5, 60, 900, 20_000]) for s in ["a", "b", "c", "dd", "é", "Z", None][:rnd.randint(2, 7)]}
        docs = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
        got = {r["_source"]: r["target"] for r in mixing.source_targets(docs).collect()}
        want = iterative_targets(sizes)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) <= 1e-9 * max(1, want[s]) for s in want)


def near_targets(planned):
    """Words taken per source within five deviations of its draws."""
    for r in planned.groupBy("source").agg(
            F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"), F.first("rate").alias("rate"),
            F.sum(F.col("size") * F.col("size")).alias("squares"), F.max(F.col("copies")).alias("most")).collect():
        part = r["rate"] % 1
        assert abs(r["taken"] - r["target"]) <= 5 * (r["squares"] * part * (1 - part)) ** 0.5 + 1e-6
        assert r["most"] <= mixing.LIMIT


def test_taken_words_come_near_the_targets(spark):
    planned = mixing.plan_mix(spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", "source"))
    near_targets(planned)
    near_targets(mixing.plan_mix(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "source")))


def test_rows_that_share_an_id_draw_apart(spark):
    rows = [(1, "seven words in a row of text", "a")] * 400 + [(None, "no id and the same text", "b")] * 400 + [
        (i, "w " * (i % 50), "c") for i in range(2, 500)]
    planned = mixing.plan_mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)).cache()
    near_targets(planned)
    for source in "ab":
        copies = collections.Counter(r["copies"] for r in planned.where(F.col("source") == source).collect())
        rate = planned.where(F.col("source") == source).first()["rate"]
        assert sum(copies.values()) == 400 and (len(copies) == 2 or rate % 1 < 0.01)
    planned.unpersist()


def test_reruns_and_layouts_agree_for_unique_ids(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", "source")
    one, other = (sorted(map(repr, mixing.plan_mix(d).select("doc_id", "copies").collect())) for d in (docs, docs.repartition(7)))
    assert one == other
    assert entry.queries()["op10_mixing"](spark, SF001).columns == ["doc_id", "size", "source_size", "target", "taken"]
