"""Reporting datasets over risk_scores, domains and the KPI features.

Every report is a group-by, a bounded top-k, or a projection.  Shares and
rankings use scalar subqueries or the distributed rank helper; nothing
funnels the domain rows through one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domainpulse.config import FEATURES, TIER_LABELS
from domainpulse.functions.tiers import tier_rank
from domainpulse.operators.ordinal import rank_by

HIGH_TIERS = ("HIGH", "CRITICAL")


def enrich(scores: DataFrame, domains: DataFrame) -> DataFrame:
    """Scores with domain attributes (domains without a score drop out)."""
    return scores.join(domains.select("domain_id", "domain_name", "owner_team", "data_source"), "domain_id")


def overview(scores: DataFrame) -> DataFrame:
    """Domains, mean score, HIGH-or-worse count."""
    return scores.agg(
        F.count(F.lit(1)).alias("domains"),
        F.avg("composite_score").alias("avg_score"),
        F.count_if(F.col("risk_tier").isin(*HIGH_TIERS)).alias("high_risk_domains"),
    )


def team_tiers(enriched: DataFrame) -> DataFrame:
    """R2: domains per owner team and tier (one column per tier)."""
    return enriched.groupBy("owner_team").pivot("risk_tier", list(TIER_LABELS)).count().na.fill(
        0, subset=list(TIER_LABELS))


def team_average(enriched: DataFrame) -> DataFrame:
    """Mean score and domain count per owner team."""
    return enriched.groupBy("owner_team").agg(
        F.avg("composite_score").alias("avg_score"), F.count(F.lit(1)).alias("domains"))


def top_domains(enriched: DataFrame, n: int = 10) -> DataFrame:
    """The n highest scores with their driver (top-k, bounded by n)."""
    return enriched.select(
        "domain_id", "domain_name", "owner_team", "composite_score", "risk_tier", "top_driver"
    ).orderBy(F.col("composite_score").desc(), F.col("domain_id")).limit(n)


def driver_distribution(scores: DataFrame) -> DataFrame:
    """Domains per top driver and their share of all domains."""
    total = scores.select(F.count(F.lit(1))).scalar()
    return scores.groupBy("top_driver").agg(F.count(F.lit(1)).alias("domains")).withColumn(
        "share", F.col("domains") / total)


def team_filter(enriched: DataFrame, teams: Sequence[str]) -> DataFrame:
    """Drill-down to the given owner teams."""
    return enriched.where(F.col("owner_team").isin(*teams))


def domain_rank(scores: DataFrame) -> DataFrame:
    """RANK by score (desc) and the gap to the mean score."""
    mean = scores.select(F.avg("composite_score")).scalar()
    ranked = rank_by(scores.select("domain_id", "composite_score", "risk_tier"), "composite_score",
                     descending=True, out="score_rank")
    return ranked.withColumn("score_vs_mean", F.col("composite_score") - mean)


def kpi_long(features: DataFrame) -> DataFrame:
    """One row per (domain, KPI) with the value's share of the KPI maximum."""
    long = features.unpivot("domain_id", list(FEATURES), "kpi", "value")
    maxima = long.groupBy("kpi").agg(F.max("value").alias("_max"))  # one row per KPI
    return long.join(F.broadcast(maxima), "kpi").select(
        "domain_id", "kpi", "value",
        F.when(F.col("_max") != 0, F.col("value") / F.col("_max")).alias("share_of_max"),
    )


def cluster_scores(scores: DataFrame) -> DataFrame:
    """Score distribution per cluster.

    Scores sit on a 0.1 grid, so the exact percentile buffers hold at
    most one entry per distinct grid value, however many rows a cluster has.
    """
    return scores.groupBy("cluster_label").agg(
        F.count(F.lit(1)).alias("domains"),
        F.avg("composite_score").alias("avg_score"),
        F.min("composite_score").alias("min_score"),
        F.percentile("composite_score", 0.25).alias("p25_score"),
        F.median("composite_score").alias("median_score"),
        F.percentile("composite_score", 0.75).alias("p75_score"),
        F.max("composite_score").alias("max_score"),
    )


def by_domain(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both frames' columns by domain id, where no id matches no id."""
    same = left["domain_id"].eqNullSafe(right["domain_id"])
    return left.join(right, same).drop(right["domain_id"])


def _with_scores(features: DataFrame, scores: DataFrame, *cols: str) -> DataFrame:
    """``features`` with columns of ``scores``: a projection where ``scores`` still carries the features."""
    if {*FEATURES} <= {*scores.columns}:
        return scores.select("domain_id", *FEATURES, *cols)
    return by_domain(features, scores.select("domain_id", *cols))


def feature_points(scaled: DataFrame, clustered: DataFrame) -> DataFrame:
    """Standardised coordinates with cluster label and tier.

    ``clustered`` frames that carry the coordinates themselves are only projected; otherwise the two
    frames are joined by domain (a domain without id keeps its row).
    """
    if set(scaled.columns) <= set(clustered.columns):
        return clustered.select(*scaled.columns, "cluster_label", "risk_tier")
    return by_domain(scaled, clustered.select("domain_id", "cluster_label", "risk_tier"))


def recent_audit(audit: DataFrame, n: int = 20) -> DataFrame:
    """The latest n audit rows (top-k)."""
    return audit.orderBy(F.col("run_id").desc()).limit(n)


def feature_correlation(features: DataFrame, scores: DataFrame) -> DataFrame:
    """Pearson correlation of each KPI with the composite score."""
    joined = _with_scores(features, scores, "composite_score")
    agg = joined.agg(*[F.corr(c, "composite_score").alias(c) for c in FEATURES])
    pairs = ", ".join(f"'{c}', {c}" for c in FEATURES)
    return agg.selectExpr(f"stack({len(FEATURES)}, {pairs}) AS (kpi, corr_with_score)")


def tier_analysis(features: DataFrame, scores: DataFrame) -> DataFrame:
    """Per final tier (all four listed): count, mean score, mean KPIs."""
    joined = _with_scores(features, scores, "composite_score", "risk_tier")
    stats = joined.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("domains"),
        F.avg("composite_score").alias("avg_score"),
        *[F.avg(c).alias(f"avg_{c}") for c in FEATURES],
    )
    tiers = scores.sparkSession.createDataFrame([(t,) for t in TIER_LABELS], ["risk_tier"])
    out = F.broadcast(tiers).join(stats, "risk_tier", "left")  # both sides bounded by the tier list
    return out.select(
        "risk_tier", tier_rank("risk_tier").alias("tier_rank"),
        F.coalesce("domains", F.lit(0)).cast("long").alias("domains"),
        "avg_score", *[f"avg_{c}" for c in FEATURES],
    )


def similar_domains(clustered: DataFrame, n: int = 5) -> DataFrame:
    """The n nearest domains in standardised feature space, within the same cluster.

    Exact and pair-free (see ``operators.similarity``).  ``clustered`` holds
    the raw features and the cluster label.  Standardised coordinates differ
    by the raw difference over the population std, so the squared raw
    differences are weighted by 1 / variance: raw features are decimal
    numbers, whose differences are exact and tie exactly.
    """
    from domainpulse.operators.features import scaler_stats
    from domainpulse.operators.similarity import similar_domains as knn

    std = scaler_stats(clustered).first()
    weights = [1.0 / (std[f"std_{c}"] * std[f"std_{c}"]) if std[f"std_{c}"] else 0.0 for c in FEATURES]
    points = clustered.select("domain_id", "cluster_label", *[F.col(c).cast("decimal(28,12)").alias(c) for c in FEATURES])
    return knn(points, FEATURES, n=n, weights=weights)
