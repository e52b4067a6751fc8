"""Shards hang on the rows alone, are near equal, and keep groups of equal texts together."""

import collections

import pytest

from domainpulse.llm import sharding


def rows_of(df):
    return sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["size"], r["shard"], r["slot"]) for r in df.collect())


def corpus(spark, n=6000, group=20, hot=0):
    """Groups of ``group`` rows with equal text, and one text of ``hot`` rows."""
    rows = [(i, f"text {i // group} " + "x" * (i // group * 37 % 60)) for i in range(n)]
    rows += [(n + i, "a hot text that many rows hold") for i in range(hot)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_shards_do_not_hang_on_the_number_of_ranges(spark, monkeypatch):
    _, docs = corpus(spark)
    got = {}
    for per_shard in (2, 40, 250):  # few wide ranges to ranges narrower than a group
        monkeypatch.setattr(sharding, "RANGES_PER_SHARD", per_shard)
        monkeypatch.setattr(sharding, "OVERSAMPLE", 4)
        got[per_shard] = rows_of(sharding.shard_by_bytes(docs))
    assert got[2] == got[40] == got[250]


def test_shards_are_near_equal_and_groups_stay_whole(spark):
    rows, docs = corpus(spark, hot=3000)  # a third of all rows in one text
    out = sharding.shard_by_bytes(docs).collect()
    held, texts = collections.Counter(), collections.defaultdict(set)
    for r in out:
        held[r["shard"]] += r["size"]
        texts[r["text"]].add(r["shard"])
    mean = sum(held.values()) / sharding.SHARDS
    assert len(out) == len(rows) and len(held) == sharding.SHARDS
    assert all(abs(b - mean) <= mean / sharding.GROUP_PART for b in held.values())
    assert all(len(s) == 1 for t, s in texts.items() if not t.startswith("a hot")) and len(texts["a hot text that many rows hold"]) > 4
    for s in held:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))


@pytest.mark.parametrize("bounds", [[], ["5"], list("13579bdf"), [f"{i:03x}" for i in range(0, 4096, 7)]])
def test_range_search(spark, bounds):
    from bisect import bisect_right

    from pyspark.sql import functions as F

    keys = [f"{i:03x}" for i in range(0, 4096, 5)] + ["1", "5", "f"]
    df = spark.createDataFrame([(k,) for k in keys], "k string").select("k", sharding._range_of(F.col("k"), bounds).alias("r"))
    assert {r["k"]: r["r"] for r in df.collect()} == {k: bisect_right(bounds, k) for k in keys}


def test_overfull_ranges_are_parted_until_no_sample_does(spark, monkeypatch):
    """Nearly all bytes in rows that one first boundary misses; rows of one id and text cannot be parted and end the search."""
    rows = [(i, "common") for i in range(3000)] + [(1, "repeated row")] * 2000 + [(9000 + i, f"other {i}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(sharding, "OVERSAMPLE", 1)
    slim = sharding.stored(sharding._keyed(docs).select("doc_id", "size", "_text_key", "_id_key", "_key"), "t")
    bounds, sizes = sharding.splitters(slim, sharding.SHARDS)
    total = sum(b for b, _ in sizes)
    ranges = sharding.SHARDS * sharding.RANGES_PER_SHARD
    assert total == sum(len(t) + 1 for _, t in rows) and sum(n for _, n in sizes) == len(rows)
    hot = sorted(sizes)[-1]
    assert hot[1] <= 2100  # the repeated row alone, as one range
    assert sorted(sizes)[-2][0] <= 4 * total / ranges
