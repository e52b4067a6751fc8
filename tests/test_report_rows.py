"""Report rows come from one projection and keep the domain without id."""

from pyspark.sql import functions as F

from domainpulse.config import FEATURES
from domainpulse.operators import cluster, features, reports, score

CENTERS = [[-1.0] * 4, [0.0] * 4, [1.0] * 4, [2.0] * 4]


def _features(spark):
    rows = [(None if i == 3 else f"D{i}", *(float(i + j) for j in range(4))) for i in range(8)]
    return spark.createDataFrame(rows, ["domain_id", *FEATURES])


def test_domain_without_id_stays_in_points_correlation_and_tiers(spark):
    feats = _features(spark)
    points = reports.feature_points(features.standardise(feats), cluster.label_points(feats, CENTERS))
    joined = reports.feature_points(features.standardise(feats), cluster.label_features(feats, CENTERS))
    assert points.count() == joined.count() == 8
    assert sorted(map(repr, points.collect())) == sorted(map(repr, joined.select(*points.columns).collect()))
    clustered = cluster.label_features(feats, CENTERS)
    whole, slim = score.score_domains(clustered), score.risk_scores(clustered, run_date="2024-01-01")
    for scores in (whole, slim):
        assert reports.tier_analysis(feats, scores).agg(F.sum("domains")).first()[0] == 8
    one, other = (sorted(map(repr, reports.feature_correlation(feats, s).selectExpr(
        "kpi", "round(corr_with_score, 9)").toDF("kpi", "c").collect())) for s in (whole, slim))
    assert one == other


def test_reports_of_scored_features_have_no_join(spark):
    feats = _features(spark)
    scores = score.score_domains(cluster.label_features(feats, CENTERS))
    for frame in (reports.feature_points(features.standardise(feats), cluster.label_points(feats, CENTERS)),
                  reports.feature_correlation(feats, scores)):
        assert "Join" not in frame._jdf.queryExecution().executedPlan().toString()
