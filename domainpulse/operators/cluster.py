"""K-means over the standardised features, cluster -> tier mapping.

Fitting collapses identical feature rows to weighted points and advances all
restarts together: a step is one grouped aggregate over (seed, nearest
centroid), with the centroids of all seeds as one constant table.  Only
the k centroids per seed reach the driver; assignment is then plain column
arithmetic against those k literal centroids, so neither fitting nor scoring
calls into Python.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from domainpulse.config import FEATURES, TIER_LABELS, ClusterParams
from domainpulse.operators.features import SCALED, standardise
from domainpulse.functions.tiers import tier_rank
from domainpulse.session import cut_lineage

Centers = list[list[float]]

#: Rows (a point for a seed) that a task of a step takes up.
STEP_ROWS = 250_000


def weighted_points(scaled: DataFrame, cols: Sequence[str] = SCALED) -> DataFrame:
    """(x0, x1, ..., w): the distinct feature rows with their number of copies."""
    return scaled.groupBy(*cols).agg(F.count(F.lit(1)).alias("w")).select(
        *[F.col(c).alias(f"x{j}") for j, c in enumerate(cols)], "w")


def _centroids(centers: dict[int, Centers], k: int, dims: int) -> Column:
    """An array with one struct per seed: its centroids' coordinates, null for those it has not drawn yet.

    It is one constant of the plan, which generated code refers to and does not spell out: the steps differ in
    its value only, so they share their compiled code, and a step needs no join and no job of its own for it.
    """
    fields = ", ".join(["seed: int", *[f"c{i}_{j}: double" for i in range(k) for j in range(dims)]])
    table = [{"seed": seed, **{f"c{i}_{j}": v for i, c in enumerate(cs) for j, v in enumerate(c)}} for seed, cs in centers.items()]
    return F.from_json(F.lit(json.dumps(table)), f"array<struct<{fields}>>")


def _nearest(k: int, dims: int) -> Column:
    """(d, i): squared distance to and index of the nearest of a row's centroids (ties: the lower index)."""
    def squared(i: int) -> Column:
        return sum(((F.col(f"x{j}") - F.col(f"c{i}_{j}")) * (F.col(f"x{j}") - F.col(f"c{i}_{j}")) for j in range(1, dims)),
                   (F.col("x0") - F.col(f"c{i}_0")) * (F.col("x0") - F.col(f"c{i}_0")))

    return F.least(*[F.when(F.col(f"c{i}_0").isNotNull(), F.struct(squared(i).alias("d"), F.lit(i).alias("i"))) for i in range(k)])


@dataclass
class KMeansFit:
    """Best of all restarts, the steps that all restarts took together, and each restart's cost."""

    centers: Centers
    cost: float
    seed: int
    steps: int
    costs: dict[int, float]


class _Restarts:
    """All restarts over one table of weighted points."""

    def __init__(self, points: DataFrame, k: int, dims: int):
        self.points, self.k, self.dims = points, k, dims
        self.x = [F.col(f"x{j}") for j in range(dims)]
        # built once, as the steps differ in the centroids only
        self.near = _nearest(k, dims).alias("near")
        far = F.struct(F.col("near.d").alias("d"), *[c.alias(f"x{j}") for j, c in enumerate(self.x)])
        self.moments = [
            F.sum("w").alias("w"), *[F.sum(F.col("w") * c).alias(f"s{j}") for j, c in enumerate(self.x)],
            F.sum(F.col("w") * F.col("near.d")).alias("cost"), F.max(far).alias("far")]

    def placed(self, centers: dict[int, Centers]) -> DataFrame:
        """Every point once per seed, with its nearest centroid of that seed."""
        per_seed = self.points.select("*", F.explode(_centroids(centers, self.k, self.dims)).alias("c")).select(
            *self.points.columns, "c.*")
        return per_seed.select("seed", *self.x, "w", self.near)

    def draw(self, centers: dict[int, Centers], step: int) -> dict[int, Centers]:
        """One more centroid per seed, drawn by weight times squared distance to the seed's centroids so far.

        The least of exponential variates with these rates belongs to a point with probability in
        proportion to its rate, so the draw is a grouped minimum; the variates are hashes of point and seed.
        """
        rate = F.col("w") * (F.lit(1.0) if step == 0 else F.col("near.d"))
        bits = F.shiftrightunsigned(F.xxhash64(*self.x, F.col("seed"), F.lit(step)), 11)
        uniform = (bits + F.lit(0.5)) / F.lit(float(1 << 53))
        drawn = self.placed(centers).where(rate > 0).groupBy("seed").agg(
            F.min(F.struct((-F.log(uniform) / rate).alias("t"), *[c.alias(f"x{j}") for j, c in enumerate(self.x)])).alias("p"))
        points = {r["seed"]: list(r["p"])[1:] for r in drawn.collect()}  # one row per seed
        return {s: [*cs, points[s]] for s, cs in centers.items()}

    def step(self, centers: dict[int, Centers]) -> tuple[dict[int, Centers], dict[int, float]]:
        """(means of the points nearest to each centroid, cost of the given centroids) per seed.

        A centroid without points moves to the point farthest from its own centroid.
        """
        rows = self.placed(centers).groupBy("seed", F.col("near.i").alias("i")).agg(*self.moments).collect()
        moved = {s: [None] * self.k for s in centers}
        cost = dict.fromkeys(centers, 0.0)
        farthest = {s: [] for s in centers}
        for r in rows:  # at most k rows per seed
            moved[r["seed"]][r["i"]] = [r[f"s{j}"] / r["w"] for j in range(self.dims)]
            cost[r["seed"]] += r["cost"]
            farthest[r["seed"]].append(tuple(r["far"]))
        for s, found in moved.items():
            spare = sorted(farthest[s], reverse=True)
            for i, c in enumerate(found):
                if c is None:
                    found[i] = list(spare.pop(0)[1:]) if spare else centers[s][i]
        return moved, cost


def fit_points(points: DataFrame, k: int, seeds: Sequence[int], max_iter: int, tolerance: float, dims: int) -> KMeansFit:
    """Restarts for ``seeds`` over ``points`` (x0, x1, ..., w).

    A restart stops when the summed squared shift of its centroids is at most ``tolerance``.
    """
    restarts = _Restarts(points, k, dims)
    centers: dict[int, Centers] = {s: [] for s in seeds}
    for step in range(k):
        centers = restarts.draw(centers, step)
    moving, steps = dict(centers), 0
    while moving and steps < max_iter:
        steps += 1
        moved, _ = restarts.step(moving)
        shift = {s: sum((a - b) ** 2 for old, new in zip(moving[s], moved[s]) for a, b in zip(old, new)) for s in moving}
        centers.update(moved)
        moving = {s: c for s, c in moved.items() if shift[s] > tolerance}
    _, costs = restarts.step(centers)
    seed = min(costs, key=lambda s: (costs[s], s))
    return KMeansFit(centers[seed], costs[seed], seed, steps, costs)


def fit_kmeans(scaled: DataFrame, params: ClusterParams = ClusterParams()) -> tuple[Centers, float, int]:
    """Best of ``params.restarts`` k-means fits -> (centers, cost, seed).

    Seeds run from ``params.seed`` upwards.  Lowest cost wins, then the lowest
    seed.  Raises ValueError when there are fewer distinct points than clusters.
    """
    points = cut_lineage(weighted_points(scaled))
    x = [f"x{j}" for j in range(len(SCALED))]
    total = F.sum("w")
    variance = [(F.sum(F.col("w") * F.col(c) * F.col(c)) / total - (F.sum(F.col("w") * F.col(c)) / total) ** 2).alias(c) for c in x]
    stats = points.agg(F.count(F.lit(1)).alias("points"), *variance).first()
    if stats["points"] < params.k:
        raise ValueError(f"need at least k={params.k} distinct feature rows, found {stats['points']}")
    # a step has a row per point and seed: AQE coalesces by the points' bytes, so the tasks are dealt out by rows here
    tasks = -(-stats["points"] * params.restarts // STEP_ROWS)
    if tasks > 1:
        points = cut_lineage(points.repartition(tasks, *x))
    spread = sum(stats[c] or 0.0 for c in x) / len(x)
    fit = fit_points(points, params.k, range(params.seed, params.seed + params.restarts), params.max_iter, params.tol * spread, len(x))
    return fit.centers, fit.cost, fit.seed


def centroid_table(spark: SparkSession, centers) -> DataFrame:
    """Centroids with severity (mean coordinate), rank and tier label.

    k rows; ids are canonicalised to the severity rank (0 = least severe),
    ties broken by original id.
    """
    rows = [(i, *[float(v) for v in c]) for i, c in enumerate(centers)]
    cols = ["cid"] + [f"c{j}" for j in range(len(FEATURES))]
    df = spark.createDataFrame(rows, cols).withColumn("cid", F.col("cid").cast("int"))
    sev = sum(F.col(f"c{j}") for j in range(len(FEATURES))) / F.lit(float(len(FEATURES)))
    ranked = sorted(rows, key=lambda r: (sum(r[1:]) / len(FEATURES), r[0]))
    order = {r[0]: rank for rank, r in enumerate(ranked)}
    rank_col = F.create_map(*[x for cid, rk in order.items() for x in (F.lit(cid), F.lit(rk))])[F.col("cid")]
    labels = F.array(*[F.lit(t) for t in TIER_LABELS])
    return df.select(
        "*", sev.alias("severity"),
        rank_col.cast("int").alias("cluster_label"),
    ).withColumn("risk_tier", labels[F.col("cluster_label")])


def assign_clusters(frame: DataFrame, centers, scaled_cols=SCALED) -> DataFrame:
    """Nearest centroid by squared Euclidean distance (ties: lowest centroid id).

    Adds ``cluster_label`` (severity rank of the centroid), ``risk_tier``
    and ``centroid_dist``.  ``centers`` is a small driver-side list (k rows).
    """
    ranked = sorted(range(len(centers)), key=lambda i: (sum(centers[i]) / len(centers[i]), i))
    rank_of = F.create_map(*[x for rank, i in enumerate(ranked) for x in (F.lit(i), F.lit(rank))])
    labels = F.array(*[F.lit(t) for t in TIER_LABELS[: len(ranked)]])
    return (
        assign_by_original_id(frame, centers, scaled_cols)
        .withColumn("cluster_label", rank_of[F.col("cid")].cast("int"))
        .withColumn("risk_tier", labels[F.col("cluster_label")])
        .withColumnRenamed("dist", "centroid_dist")
        .drop("cid")
    )


def assign_by_original_id(frame: DataFrame, centers, scaled_cols=SCALED) -> DataFrame:
    """Nearest centroid keeping the centroid's original index (ties: lowest id)."""
    cands = []
    for i, c in enumerate(centers):
        d = sum((F.col(s) - F.lit(float(v))) * (F.col(s) - F.lit(float(v))) for s, v in zip(scaled_cols, c))
        cands.append(F.struct(d.alias("d"), F.lit(i).alias("cid")))
    return frame.withColumn("_best", F.array_min(F.array(*cands))).select(
        "*", F.col("_best.cid").alias("cid"), F.col("_best.d").alias("dist")
    ).drop("_best")


def cluster_features(features: DataFrame, scaled: DataFrame, centers) -> DataFrame:
    """Raw features + cluster label + cluster tier, of two frames keyed by domain_id."""
    assigned = assign_clusters(scaled, centers).select("domain_id", "cluster_label", "risk_tier")
    # a domain without id is a group of the rollup like any other and keeps its row
    same = features["domain_id"].eqNullSafe(assigned["domain_id"])
    return features.join(assigned, same).drop(assigned["domain_id"])


def label_features(features: DataFrame, centers) -> DataFrame:
    """Raw features + cluster label + cluster tier as one projection: scaled, assigned and kept row by row."""
    scaled = standardise(features, keep=("domain_id", *FEATURES))
    return assign_clusters(scaled, centers).select("domain_id", *FEATURES, "cluster_label", "risk_tier")


def label_points(features: DataFrame, centers) -> DataFrame:
    """Standardised coordinates + cluster label + cluster tier as one projection."""
    return assign_clusters(standardise(features), centers).select("domain_id", *SCALED, "cluster_label", "risk_tier")


def tier_profile(clustered: DataFrame) -> DataFrame:
    """Domain count and mean raw KPIs per tier, least to most severe."""
    return (
        clustered.groupBy("risk_tier")
        .agg(F.count(F.lit(1)).alias("domains"), *[F.avg(c).alias(f"mean_{c}") for c in FEATURES])
        .orderBy(tier_rank("risk_tier"))
    )


def tier_distribution(df: DataFrame, tier_col: str = "risk_tier", order=("CRITICAL", "HIGH", "MEDIUM", "LOW")) -> DataFrame:
    """Dense counts per tier: every label appears, missing ones with 0."""
    spark = df.sparkSession
    tiers = spark.createDataFrame([(t, i) for i, t in enumerate(order)], ["risk_tier", "tier_order"])
    counts = df.groupBy(F.col(tier_col).alias("risk_tier")).agg(F.count(F.lit(1)).alias("domains"))
    # Both sides are bounded by the number of tier labels.
    return (
        F.broadcast(tiers).join(counts, "risk_tier", "left")
        .select("risk_tier", F.col("tier_order").cast("int").alias("tier_order"),
                F.coalesce("domains", F.lit(0)).cast("long").alias("domains"))
        .orderBy("tier_order")
    )
