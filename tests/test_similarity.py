"""Exact nearest-N within a cluster vs an exact brute force, with hot identical groups."""

import math
import random
from fractions import Fraction

from pyspark.sql import functions as F

from domainpulse.operators.similarity import LEAF, build_tree, nearest_sites, similar_domains
from domainpulse.session import cut_lineage

COLS = ["a", "b", "c", "d"]


def _brute(rows, n):
    out = []
    for r in rows:
        cand = sorted(
            (sum((Fraction(str(x)) - Fraction(str(y))) ** 2 for x, y in zip(r[2:], s[2:])), s[0])
            for s in rows if s[0] != r[0] and s[1] == r[1])
        out += [(r[0], r[1], sid, k + 1, round(math.sqrt(float(d)), 9)) for k, (d, sid) in enumerate(cand[:n])]
    return sorted(out)


def test_matches_brute_force_with_identical_groups(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(160):
        if i < 40:
            c, v = 0, (0.0, 0.0, 0.0, 0.0)           # hot group of identical vectors
        elif i < 44:
            c, v = 1, (1.0, 1.0, 1.0, 1.0)           # small identical group (fewer than n)
        else:
            c, v = rnd.randint(0, 2), tuple(round(rnd.gauss(0, 1), 1) for _ in range(4))
        rows.append((f"D{i:03d}", c, *v))
    rows.append(("LONE", 7, 0.0, 0.0, 0.0, 0.0))    # a cluster of one: no neighbours
    df = spark.createDataFrame(rows, ["domain_id", "cluster_label", *COLS]).select(
        "domain_id", "cluster_label", *[F.col(c).cast("decimal(15,9)").alias(c) for c in COLS])
    got = sorted((r.domain_id, r.cluster_label, r.neighbor_id, r.neighbor_rank, round(r.distance, 9))
                 for r in similar_domains(df, COLS, n=5).collect())
    assert got == _brute(rows, 5)


import pytest  # noqa: E402


@pytest.mark.parametrize("seed,n", [(1, 1), (2, 3), (3, 7)])
def test_matches_brute_force_random_clumps(spark, seed, n):
    rnd = random.Random(seed)
    centres = [tuple(rnd.uniform(-3, 3) for _ in range(4)) for _ in range(3)]
    rows = []
    for i in range(120):
        cx = centres[i % 3]
        spread = 0.05 if i % 2 else 1.0          # tight clumps next to a wide spread
        rows.append((f"P{i:03d}", i % 2, *(round(c + rnd.gauss(0, spread), 2) for c in cx)))
    df = spark.createDataFrame(rows, ["domain_id", "cluster_label", *COLS]).select(
        "domain_id", "cluster_label", *[F.col(c).cast("decimal(15,9)").alias(c) for c in COLS])
    got = sorted((r.domain_id, r.cluster_label, r.neighbor_id, r.neighbor_rank, round(r.distance, 9))
                 for r in similar_domains(df, COLS, n=n).collect())
    assert got == _brute(rows, n)


def _sites(spark, rows):
    df = spark.createDataFrame(rows, ["domain_id", "cluster_label", *COLS])
    return cut_lineage(df.withColumn("site", F.monotonically_increasing_id()).withColumn("q", F.lit(0)).withColumn("m", F.lit(1)))


def test_clump_and_far_sites_meet_few_others_in_few_rounds(spark):
    """A tight clump next to far sites a million times wider: neither meets a share of all sites."""
    rnd = random.Random(4)
    rows = [(f"C{i}", 0, *(rnd.gauss(0, 1e-3) for _ in range(4))) for i in range(2000)]
    rows += [(f"F{i}", 0, *(rnd.gauss(0, 1e3) for _ in range(4))) for i in range(1000)]
    found = nearest_sites(_sites(spark, rows), COLS, 5)
    met = found.found.agg(F.count(F.lit(1)), F.sum("met"), F.max("met")).first()
    assert met[0] == len(rows) and found.rounds <= 12
    assert met[1] < len(rows) * 400 and met[2] < 1000  # all pairs: 9,000,000
    pts = dict((r[0], r[2:]) for r in rows)
    ids = {r.site: r.domain_id for r in _sites(spark, rows).select("site", "domain_id").collect()}
    for r in found.found.where("site % 97 = 0").collect():
        own = ids[r.site]
        near = sorted((sum((a - b) ** 2 for a, b in zip(pts[own], p)), o) for o, p in pts.items() if o != own)[:5]
        assert [b.id for b in r.best] == [o for _, o in near]


def test_tree_parts_values_that_mostly_tie(spark):
    """Nine tenths of all sites share three of four coordinates; leaves hold at most LEAF sites all the same."""
    rows = [(f"T{i}", 0, 1.0, 1.0, 1.0, float(i)) for i in range(900)] + [
        (f"V{i}", 0, float(i % 3), float(i % 5), 0.5, float(i)) for i in range(100)]
    sites = _sites(spark, rows).select("site", F.lit("0").alias("tree"), F.array(*COLS).alias("x"))
    tree = build_tree(sites, 4)
    held = tree.leaves.select(F.size("members").alias("n")).agg(F.sum("n"), F.max("n")).first()
    assert held[0] == len(rows) and held[1] <= LEAF and tree.depth <= 8


def test_weights_scale_the_differences(spark):
    df = spark.createDataFrame([("A", 0, 0.0, 0.0), ("B", 0, 3.0, 0.0), ("C", 0, 0.0, 4.0)], "domain_id string, cluster_label int, a double, b double")
    plain = {r.domain_id: r.neighbor_id for r in similar_domains(df, ["a", "b"], n=1).collect()}
    scaled = {r.domain_id: (r.neighbor_id, r.distance) for r in similar_domains(df, ["a", "b"], n=1, weights=[4.0, 0.25]).collect()}
    assert plain["A"] == "B" and scaled["A"] == ("C", 2.0)
