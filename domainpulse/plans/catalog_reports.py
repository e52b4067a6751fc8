"""Catalog entries for the reporting datasets (events bridge, literal centroids)."""

from __future__ import annotations

from domainpulse.config import DEMO_CENTROIDS, FEATURES
from domainpulse.operators import cluster as cluster_ops
from domainpulse.operators import features as feature_ops
from domainpulse.operators import reports as rep
from domainpulse.operators import score as score_ops
from domainpulse.plans import bridges
from domainpulse.plans.catalog import EVENTS, RUN_DATE, events_features, query, r6
from domainpulse.plans.catalog_quality import q_dq_report_lineitem
from domainpulse.operators.quality import audit_rows

TEAMS = ("BUILDING", "MACHINERY")


def frames(spark, base):
    feats = events_features(spark, base)
    scaled = feature_ops.standardise(feats)
    clustered = cluster_ops.label_features(feats, DEMO_CENTROIDS)
    scores = score_ops.risk_scores(clustered, EVENTS.score, RUN_DATE)
    return feats, scaled, clustered, scores


def scored(spark, base):
    """(features, features with components, score, tiers and driver): one row per domain, no join."""
    feats = events_features(spark, base)
    return feats, score_ops.score_domains(cluster_ops.label_features(feats, DEMO_CENTROIDS), EVENTS.score)


def enriched(spark, base):
    return rep.enrich(frames(spark, base)[3], bridges.events_domains(spark, base))


@query("report_overview")
def q_report_overview(spark, base):
    return r6(rep.overview(frames(spark, base)[3]), ("avg_score",))


@query("report_team_tiers")
def q_report_team_tiers(spark, base):
    return rep.team_tiers(enriched(spark, base))


@query("report_team_avg")
def q_report_team_avg(spark, base):
    return r6(rep.team_average(enriched(spark, base)), ("avg_score",))


@query("report_top_domains")
def q_report_top_domains(spark, base):
    return rep.top_domains(enriched(spark, base), 10)


@query("report_driver_dist")
def q_report_driver_dist(spark, base):
    return r6(rep.driver_distribution(frames(spark, base)[3]), ("share",))


@query("report_team_filter")
def q_report_team_filter(spark, base):
    return rep.team_filter(enriched(spark, base), TEAMS)


@query("report_domain_rank")
def q_report_domain_rank(spark, base):
    return r6(rep.domain_rank(frames(spark, base)[3]), ("score_vs_mean",))


@query("report_kpi_long")
def q_report_kpi_long(spark, base):
    return r6(rep.kpi_long(frames(spark, base)[0]), ("share_of_max",))


@query("report_cluster_scores")
def q_report_cluster_scores(spark, base):
    cols = ("avg_score", "p25_score", "median_score", "p75_score")
    return r6(rep.cluster_scores(frames(spark, base)[3]), cols)


@query("report_feature_points")
def q_report_feature_points(spark, base):
    feats = events_features(spark, base)
    points = cluster_ops.label_points(feats, DEMO_CENTROIDS)
    return r6(rep.feature_points(feature_ops.standardise(feats), points), feature_ops.SCALED)


@query("recent_audit")
def q_recent_audit(spark, base):
    return rep.recent_audit(audit_rows(q_dq_report_lineitem(spark, base)).drop("run_ts"), 20)


@query("report_feature_corr")
def q_report_feature_corr(spark, base):
    feats, scores = scored(spark, base)
    return r6(rep.feature_correlation(feats, scores), ("corr_with_score",))


@query("report_tier_analysis")
def q_report_tier_analysis(spark, base):
    feats, scores = scored(spark, base)
    return r6(rep.tier_analysis(feats, scores), ("avg_score", *[f"avg_{c}" for c in FEATURES]))


@query("report_similar_domains")
def q_report_similar_domains(spark, base):
    clustered = cluster_ops.label_features(events_features(spark, base), DEMO_CENTROIDS)
    return r6(rep.similar_domains(clustered, n=5), ("distance",))
