"""All restarts in step: a known best partition, brute force, copies as weights, jobs per step."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from domainpulse.config import FEATURES, ClusterParams
from domainpulse.operators import cluster as co
from domainpulse.operators.features import SCALED

CENTRES = ((-2.0, -2.0, -1.0, -1.0), (-0.5, 0.5, -1.0, 1.0), (1.0, -1.0, 1.0, 0.0), (3.0, 3.0, 2.0, 2.0))


def frame(spark, points):
    return spark.createDataFrame([(f"D{i}", *map(float, p)) for i, p in enumerate(points)],
                                 "domain_id string, " + ", ".join(f"{c} double" for c in SCALED))


def blobs(sizes=(40, 30, 20, 10), spread=0.05, seed=3):
    rnd = random.Random(seed)
    return [(k, tuple(c + rnd.gauss(0, spread) for c in CENTRES[k])) for k, n in enumerate(sizes) for _ in range(n)]


def cost_of(groups):
    total = 0.0
    for pts in groups:
        mean = [sum(c) / len(pts) for c in zip(*pts)]
        total += sum((a - b) ** 2 for p in pts for a, b in zip(p, mean))
    return total


def test_known_best_partition(spark):
    """Four far blobs: the partition, its cost and the tiers from least to most severe."""
    rows = blobs()
    scaled = frame(spark, [p for _, p in rows])
    centers, cost, seed = co.fit_kmeans(scaled)
    assert cost == pytest.approx(cost_of([[p for k, p in rows if k == j] for j in range(4)]), rel=1e-9)
    assert 42 <= seed < 62
    got = {r.domain_id: (r.cluster_label, r.risk_tier) for r in co.assign_clusters(scaled, centers).collect()}
    tiers = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
    assert got == {f"D{i}": (k, tiers[k]) for i, (k, _) in enumerate(rows)}


def test_restarts_reach_the_least_cost_of_all_partitions(spark):
    rnd = random.Random(8)
    points = [tuple(rnd.uniform(-1, 1) for _ in range(4)) for _ in range(9)]
    least = min(cost_of(groups) for labels in itertools.product(range(3), repeat=9) if labels[0] == 0 and set(labels) == {0, 1, 2}
                for groups in [[[p for p, l in zip(points, labels) if l == g] for g in range(3)]])
    _, cost, _ = co.fit_kmeans(frame(spark, points), ClusterParams(k=3))
    assert cost == pytest.approx(least, rel=1e-9)


def test_copies_weigh_and_cost_one_row(spark):
    """A vector of a third of all domains is one weighted point, and the fit is that of all rows."""
    rows = blobs()
    hot = rows[0][1]
    points = [p for _, p in rows] + [hot] * 50
    weighted = co.weighted_points(frame(spark, points))
    assert weighted.count() == len(rows) and weighted.agg(F.max("w")).first()[0] == 51
    groups = [[p for k, p in rows if k == j] + ([hot] * 50 if j == 0 else []) for j in range(4)]
    _, cost, _ = co.fit_kmeans(frame(spark, points))
    assert cost == pytest.approx(cost_of(groups), rel=1e-9)


def test_an_empty_cluster_moves_to_the_farthest_point(spark):
    points = co.weighted_points(frame(spark, [p for _, p in blobs()])).coalesce(1)
    start = [list(CENTRES[0]), list(CENTRES[1]), [50.0] * 4, [60.0] * 4]  # the last two are nearest to nothing
    moved, _ = co._Restarts(points, 4, 4).step({1: start})
    assert all(max(map(abs, c)) < 10 for c in moved[1])
    assert len({tuple(c) for c in moved[1]}) == 4


def test_a_step_costs_the_same_jobs_for_any_number_of_restarts(spark):
    points = co.weighted_points(frame(spark, [p for _, p in blobs()])).coalesce(1).cache()
    points.count()
    sc, jobs = spark.sparkContext, {}
    for n in (1, 20):
        sc.setJobGroup(f"kmeans-{n}", "")
        co._Restarts(points, 4, 4).step({s: [list(c) for c in CENTRES] for s in range(n)})
        jobs[n] = len(sc.statusTracker().getJobIdsForGroup(f"kmeans-{n}"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    points.unpersist()
    assert jobs[1] == jobs[20] <= 2


def test_centres_are_means_and_seeds_are_repeatable(spark):
    rnd = random.Random(2)
    scaled = frame(spark, [tuple(rnd.gauss(0, 1) for _ in range(4)) for _ in range(200)])
    centers, cost, seed = co.fit_kmeans(scaled, ClusterParams(tol=0.0))
    assert co.fit_kmeans(scaled, ClusterParams(tol=0.0))[1:] == (pytest.approx(cost), seed)
    placed = co.assign_by_original_id(scaled, centers)
    for r in placed.groupBy("cid").agg(*[F.avg(c).alias(c) for c in SCALED]).collect():
        assert [r[c] for c in SCALED] == pytest.approx(centers[r["cid"]], abs=1e-9)
    assert placed.agg(F.sum("dist")).first()[0] == pytest.approx(cost)
    assert len(FEATURES) == len(centers[0])
