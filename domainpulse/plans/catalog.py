"""Query catalog: one Spark query per operator, keyed like the oracle SQL.

Every query reads the driver's raw tables through a bridge (a profiler
call), so its work grows with the tables.  Numeric outputs that feed an
equality check are rounded with the decimal recipe (see
``functions.rounding``); the library functions themselves stay unrounded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domainpulse.config import DEMO_CENTROIDS, EVENTS, FEATURES, LINEITEM, REFERENCE, TIER_LABELS, PipelineConfig
from domainpulse.functions.rounding import round_half_up
from domainpulse.operators import cluster as cluster_ops
from domainpulse.operators import features as feature_ops
from domainpulse.operators import gaps as gap_ops
from domainpulse.operators import kpi as kpi_ops
from domainpulse.operators import score as score_ops
from domainpulse.plans import bridges
from domainpulse.session import cut_lineage

RUN_DATE = "2024-02-01"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def events_kpi(spark: SparkSession, base: str, cfg=EVENTS) -> DataFrame:
    return kpi_ops.kpi_summary(bridges.events_metrics(spark, base), cfg.window_days)


def lineitem_kpi(spark: SparkSession, base: str, cfg=LINEITEM) -> DataFrame:
    return kpi_ops.kpi_summary(
        bridges.lineitem_metrics(spark, base), cfg.window_days, bridges.lineitem_dates(spark, base))


def stored_kpi(kpi: DataFrame) -> DataFrame:
    """The rollup as the feature stages read it: checkpointed once.

    Feature building runs several passes (null guard, medians, scaler
    statistics, ranks, similarity rounds); over the lazy rollup each one
    would re-profile the raw tables.  The rollup has one row per domain,
    so materialising it is cheap and every later pass reads that instead.
    """
    return cut_lineage(kpi)


# --- profiler, window, rollup -------------------------------------------
@query("profile_events")
def q_profile_events(spark, base):
    return bridges.events_metrics(spark, base)


@query("profile_lineitem")
def q_profile_lineitem(spark, base):
    return bridges.lineitem_metrics(spark, base)


@query("window_filter")
def q_window_filter(spark, base):
    return kpi_ops.window_filter(bridges.events_metrics(spark, base), EVENTS.window_days)


@query("kpi_summary")
def q_kpi_summary(spark, base):
    return events_kpi(spark, base)


@query("kpi_lineitem")
def q_kpi_lineitem(spark, base):
    return lineitem_kpi(spark, base)


@query("kpi_ranked")
def q_kpi_ranked(spark, base):
    return kpi_ops.rank_kpi(events_kpi(spark, base))


@query("feature_input")
def q_feature_input(spark, base):
    return kpi_ops.feature_input(events_kpi(spark, base))


# --- gaps ---------------------------------------------------------------
@query("gap_candidates")
def q_gap_candidates(spark, base):
    g = gap_ops.gap_candidates(events_kpi(spark, base), bridges.events_domains(spark, base), EVENTS.gaps)
    return gap_ops.rank_gaps(g)


@query("gap_candidates_reference")
def q_gap_candidates_reference(spark, base):
    return gap_ops.gap_candidates(events_kpi(spark, base), bridges.events_domains(spark, base), REFERENCE.gaps)


@query("gap_all_domains")
def q_gap_all_domains(spark, base):
    return gap_ops.gap_candidates(events_kpi(spark, base), bridges.events_domains(spark, base), EVENTS.gaps,
                                  only_breaches=False)


@query("gap_lineitem")
def q_gap_lineitem(spark, base):
    return gap_ops.gap_candidates(lineitem_kpi(spark, base), bridges.lineitem_suppliers(spark, base), LINEITEM.gaps)


# --- features -------------------------------------------------------------
def r6(df: DataFrame, cols) -> DataFrame:
    """Round the given double columns to 6 decimals for equality checks."""
    return df.select(*[round_half_up(F.col(c), 6).alias(c) if c in cols else F.col(c) for c in df.columns])


def events_features(spark, base, cfg=EVENTS) -> DataFrame:
    return feature_ops.build_features(stored_kpi(events_kpi(spark, base, cfg)))


def events_clustered(spark, base, cfg=EVENTS, centers=DEMO_CENTROIDS) -> DataFrame:
    feats = events_features(spark, base, cfg)
    return cluster_ops.label_features(feats, centers)


def events_scored(spark, base, cfg: PipelineConfig = EVENTS) -> DataFrame:
    return score_ops.score_domains(events_clustered(spark, base, cfg), cfg.score)


@query("feature_null_counts")
def q_feature_null_counts(spark, base):
    return feature_ops.null_counts(events_kpi(spark, base))


@query("features_raw")
def q_features_raw(spark, base):
    return feature_ops.raw_features(events_kpi(spark, base))


@query("features_imputed")
def q_features_imputed(spark, base):
    return feature_ops.impute_median(feature_ops.raw_features(stored_kpi(events_kpi(spark, base))))


@query("features_imputed_nulls")
def q_features_imputed_nulls(spark, base):
    """Imputation with something to do: every feature is taken away from a fifth of the domains."""
    feats = feature_ops.raw_features(stored_kpi(events_kpi(spark, base)))
    return feature_ops.impute_median(feats.select("domain_id", *[
        F.when(F.expr(f"CAST(substring(domain_id, 2) AS BIGINT) % 5 <> {j}"), F.col(c)).alias(c)
        for j, c in enumerate(FEATURES)]))


@query("features_scaled")
def q_features_scaled(spark, base):
    return r6(feature_ops.standardise(events_features(spark, base)), feature_ops.SCALED)


@query("features_scaled_lineitem")
def q_features_scaled_lineitem(spark, base):
    feats = feature_ops.build_features(stored_kpi(lineitem_kpi(spark, base)))
    return r6(feature_ops.standardise(feats), feature_ops.SCALED)


@query("scaler_params")
def q_scaler_params(spark, base):
    return r6(feature_ops.scaler_params(events_features(spark, base)), ("mean", "std"))


# --- clustering -----------------------------------------------------------
@query("nearest_centroid")
def q_nearest_centroid(spark, base):
    scaled = feature_ops.standardise(events_features(spark, base))
    out = cluster_ops.assign_clusters(scaled, DEMO_CENTROIDS)
    return r6(out.select("domain_id", "cluster_label", "risk_tier", "centroid_dist"), ("centroid_dist",))


@query("centroid_rank")
def q_centroid_rank(spark, base):
    # Centroids are literals; the query still ranks them next to the
    # domains each one attracts, so it reads the tables.
    scaled = feature_ops.standardise(events_features(spark, base))
    assigned = cluster_ops.assign_by_original_id(scaled, DEMO_CENTROIDS)
    members = assigned.groupBy("cid").agg(F.count(F.lit(1)).alias("members"))
    cents = cluster_ops.centroid_table(spark, DEMO_CENTROIDS)
    out = cents.join(members, "cid", "left").select(
        "cid", "severity", "cluster_label", "risk_tier",
        F.coalesce("members", F.lit(0)).cast("long").alias("members"))
    return r6(out, ("severity",))


@query("kmeans_clusters")
def q_kmeans_clusters(spark, base):
    feats = events_features(spark, base)
    scaled = feature_ops.standardise(feats)
    centers, _, _ = cluster_ops.fit_kmeans(scaled, EVENTS.cluster)
    return cluster_ops.label_features(feats, centers)


@query("cluster_tiers")
def q_cluster_tiers(spark, base):
    feats = events_features(spark, base)
    scaled = feature_ops.standardise(feats)
    centers, cost, seed = cluster_ops.fit_kmeans(scaled, EVENTS.cluster)
    cents = cluster_ops.centroid_table(spark, centers)
    return cents.withColumn("training_cost", F.lit(cost)).withColumn("seed", F.lit(seed))


@query("kmeans_invariants")
def q_kmeans_invariants(spark, base):
    """What must hold of any converged fit, per domain: its label is one of k, no other cluster's mean is much
    nearer than its own, its tier goes by the rank of its cluster's mean, and the fit costs no more than fixed centroids."""
    scaled = cut_lineage(feature_ops.standardise(events_features(spark, base)))
    centers, cost, _ = cluster_ops.fit_kmeans(scaled, EVENTS.cluster)
    labelled = cluster_ops.assign_clusters(scaled, centers)
    means = labelled.groupBy("cluster_label").agg(*[F.avg(c).alias(c) for c in feature_ops.SCALED]).orderBy("cluster_label").collect()
    means = [[r[c] for c in feature_ops.SCALED] for r in means]  # k rows
    severity = [sum(m) for m in means]
    fixed = cluster_ops.assign_by_original_id(scaled, DEMO_CENTROIDS).agg(F.sum("dist")).first()[0]
    near = cluster_ops.assign_by_original_id(labelled, means)
    own = F.element_at(F.array(*[
        sum((F.col(c) - F.lit(v)) * (F.col(c) - F.lit(v)) for c, v in zip(feature_ops.SCALED, m)) for m in means]), F.col("cluster_label") + 1)
    return near.select(
        "domain_id", F.lit(len(means)).alias("clusters"),
        F.col("cluster_label").between(0, EVENTS.cluster.k - 1).alias("label_known"),
        (F.sqrt(own) <= F.sqrt("dist") + F.lit(0.05)).alias("own_mean_nearest"),
        (F.element_at(F.array(*[F.lit(t) for t in TIER_LABELS]), F.col("cluster_label") + 1) == F.col("risk_tier")).alias("tier_by_rank"),
        F.lit(severity == sorted(severity)).alias("ranked_by_severity"), F.lit(cost <= fixed).alias("cheaper_than_fixed"))


@query("tier_profile")
def q_tier_profile(spark, base):
    prof = cluster_ops.tier_profile(events_clustered(spark, base))
    return r6(prof, tuple(f"mean_{c}" for c in FEATURES))


@query("tier_distribution")
def q_tier_distribution(spark, base):
    return cluster_ops.tier_distribution(events_clustered(spark, base))


# --- scoring ------------------------------------------------------------
@query("score_components")
def q_score_components(spark, base):
    df = events_scored(spark, base).select("domain_id", *[f"score_{c}" for c in FEATURES], "composite_score")
    return r6(df, tuple(f"score_{c}" for c in FEATURES))


@query("composite_score")
def q_composite_score(spark, base):
    return events_scored(spark, base).select("domain_id", "composite_score")


@query("score_tier")
def q_score_tier(spark, base):
    return events_scored(spark, base).select("domain_id", "composite_score", "score_tier")


@query("score_tier_contiguous")
def q_score_tier_contiguous(spark, base):
    cfg = PipelineConfig(window_days=EVENTS.window_days, gaps=EVENTS.gaps,
                         score=EVENTS.score.__class__(EVENTS.score.weights, EVENTS.score.ceilings, "contiguous"))
    return events_scored(spark, base, cfg).select("domain_id", "composite_score", "score_tier")


@query("reconciled_tier")
def q_reconciled_tier(spark, base):
    return events_scored(spark, base).select("domain_id", "score_tier", "cluster_tier", "risk_tier")


@query("top_driver")
def q_top_driver(spark, base):
    return events_scored(spark, base).select("domain_id", "top_driver")


def events_risk_scores(spark, base, cfg=EVENTS) -> DataFrame:
    return score_ops.risk_scores(events_clustered(spark, base, cfg), cfg.score, RUN_DATE)


@query("risk_scores")
def q_risk_scores(spark, base):
    return events_risk_scores(spark, base)


@query("risk_scores_reference")
def q_risk_scores_reference(spark, base):
    cfg = PipelineConfig(window_days=EVENTS.window_days, gaps=EVENTS.gaps)  # reference ceilings
    return events_risk_scores(spark, base, cfg)


@query("risk_scores_lineitem")
def q_risk_scores_lineitem(spark, base):
    feats = feature_ops.build_features(stored_kpi(lineitem_kpi(spark, base)))
    clustered = cluster_ops.label_features(feats, DEMO_CENTROIDS)
    return score_ops.risk_scores(clustered, LINEITEM.score, RUN_DATE)


@query("risk_ranking")
def q_risk_ranking(spark, base):
    return score_ops.rank_scores(events_risk_scores(spark, base))


@query("risk_scores_fitted")
def q_risk_scores_fitted(spark, base):
    """The whole chain as a user runs it: raw events -> metrics -> KPI -> fitted k-means -> scores."""
    from domainpulse.plans.chain import run_chain

    metrics = bridges.events_metrics(spark, base)
    res = run_chain(bridges.events_domains(spark, base), metrics, EVENTS, run_date=RUN_DATE, validate=False)
    return res.scores


@query("risk_scores_fitted_lineitem")
def q_risk_scores_fitted_lineitem(spark, base):
    """The same over line items joined to their orders; the window's predicate reaches the line items before the join."""
    from domainpulse.plans.chain import run_chain

    metrics = bridges.lineitem_metrics(spark, base)
    res = run_chain(bridges.lineitem_suppliers(spark, base), metrics, LINEITEM, run_date=RUN_DATE, validate=False,
                    dates=bridges.lineitem_dates(spark, base))
    return res.scores
