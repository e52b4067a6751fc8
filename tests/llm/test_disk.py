"""What the near-duplicate and embedding joins hold on disk does not follow from tables they no longer need."""

import os
import random

from pyspark.sql import functions as F

from domainpulse.llm import common, jaccard
from domainpulse.session import intermediates


def texts(rnd):
    rows = [(i, " ".join(f"w{rnd.randrange(5000)}" for _ in range(60))) for i in range(200)]
    rows += [(1000 + i, rows[i][1] + " more") for i in range(20)]  # near copies
    return rows + [(2000, None), (2001, " "), (None, rows[30][1] + " end"), rows[40], rows[40]]


def test_screened_parts(spark, monkeypatch):
    monkeypatch.setattr(common, "SCREEN_BITS", 1 << 17)
    rows = spark.range(20_000).withColumn("_bits", F.lit("kept"))
    hashes = spark.range(500).select(F.xxhash64((F.col("id") * 40).alias("id")).alias("h"))
    some, others = common.screened(rows, F.xxhash64("id"), hashes, "h")
    assert some.columns == others.columns == ["id", "_bits"]
    first, second = {r["id"] for r in some.collect()}, {r["id"] for r in others.collect()}
    assert first | second == set(range(20_000)) and not first & second
    assert {i * 40 for i in range(500)} <= first and len(first) < 800
    none, all_ = common.screened(rows, F.xxhash64("id"), hashes.limit(0), "h")
    assert none.count() == 0 and all_.count() == 20_000


def test_near_copies_over_large_tables(spark, monkeypatch):
    """Key tables too large to broadcast, and blocks in several rounds: the same rows, and the signatures' table goes."""
    docs = spark.createDataFrame(texts(random.Random(3)), "doc_id long, text string").repartition(4)
    want = sorted(jaccard.one_of_each(docs).collect(), key=str)
    classes = sorted(jaccard.jaccard_classes(docs).collect(), key=str)
    assert len(want) == 200 + 2 + 2
    monkeypatch.setattr(jaccard, "ROUND_BYTES", 1 << 10)
    monkeypatch.setattr(jaccard, "small", lambda df, *_: df)
    monkeypatch.setattr(jaccard, "is_small", lambda df, *_: False)
    with intermediates(spark) as made:
        assert sorted(jaccard.one_of_each(docs).collect(), key=str) == want
        there = [p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in made if os.path.exists(p.removeprefix("file:"))]
        assert "jaccard-sets" not in there and there.count("jaccard-ties") == jaccard.ROUNDS and there.count("screen") == 2
    assert sorted(jaccard.jaccard_classes(docs).collect(), key=str) == classes


def test_shuffle_files_go_with_their_query(spark):
    """A written intermediate leaves no shuffle files; the session's setting is as before."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, seen = spark.conf.get(key), []
    write = common.write
    try:
        common.write = lambda df, path: (seen.append(spark.conf.get(key)), write(df, path))
        common.stored(spark.range(1000).repartition(4, "id"), "some")
    finally:
        common.write = write
    assert seen == ["true"] and spark.conf.get(key) == before
