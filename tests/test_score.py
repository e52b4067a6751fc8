"""Scoring rules: caps, bands, reconciliation, driver (FIXTURES.md section 4)."""

import pytest
from pyspark.sql import functions as F

from domainpulse.config import FEATURES, TIER_LABELS, ScoreParams
from domainpulse.functions.tiers import band_tier, reconcile_tier
from domainpulse.operators.score import risk_scores, score_domains

BANDS = [
    (0.0, "LOW", "LOW"), (25.0, "LOW", "LOW"), (25.5, "LOW", "MEDIUM"), (26.0, "MEDIUM", "MEDIUM"),
    (50.0, "MEDIUM", "MEDIUM"), (50.5, "LOW", "HIGH"), (51.0, "HIGH", "HIGH"), (75.0, "HIGH", "HIGH"),
    (75.5, "LOW", "CRITICAL"), (76.0, "CRITICAL", "CRITICAL"), (100.0, "CRITICAL", "CRITICAL"),
    (-3.0, "LOW", "LOW"), (None, "LOW", "LOW"),
]


def test_bands(spark):
    df = spark.createDataFrame([(b[0],) for b in BANDS], "s double")
    got = df.select(band_tier("s", "reference").alias("r"), band_tier("s", "contiguous").alias("c")).collect()
    assert [(g.r, g.c) for g in got] == [(b[1], b[2]) for b in BANDS]


RECONCILE = {
    "LOW": ["LOW", "LOW", "HIGH", "CRITICAL"],
    "MEDIUM": ["MEDIUM", "MEDIUM", "MEDIUM", "CRITICAL"],
    "HIGH": ["HIGH", "HIGH", "HIGH", "HIGH"],
    "CRITICAL": ["CRITICAL", "CRITICAL", "CRITICAL", "CRITICAL"],
}


def test_reconciliation_table(spark):
    rows = [(s, c) for s in TIER_LABELS for c in TIER_LABELS] + [("LOW", "BOGUS"), ("HIGH", None)]
    df = spark.createDataFrame(rows, "s string, c string")
    got = [r.t for r in df.select(reconcile_tier("s", "c").alias("t")).collect()]
    want = [RECONCILE[s][TIER_LABELS.index(c)] for s in TIER_LABELS for c in TIER_LABELS] + ["LOW", "HIGH"]
    assert got == want


def _clustered(spark, rows):
    schema = "domain_id string, " + ", ".join(f"{c} double" for c in FEATURES) + ", cluster_label int, risk_tier string"
    return spark.createDataFrame(rows, schema)


def test_components_cap_negative_and_driver_tie(spark):
    df = _clustered(spark, [
        ("CAP", 0.0, 0.0, 100.0, 0.0, 0, "LOW"),
        ("NEG", 0.0, 0.0, -7.2, 0.0, 0, "LOW"),
        ("ZERO", 0.0, 0.0, 0.0, 0.0, 0, "LOW"),
        ("MIX", 0.5, 0.2, 36.0, 20.0, 1, "MEDIUM"),
    ])
    out = {r.domain_id: r for r in score_domains(df).collect()}
    assert out["CAP"].score_avg_update_lag == 1.0
    assert out["NEG"].score_avg_update_lag == pytest.approx(-0.1)
    assert out["ZERO"].top_driver == "avg_null_rate"
    # 0.5*.30 + 0.2*.25 + 0.5*.30 + 1.0*.15 = 0.5
    assert out["MIX"].composite_score == 50.0
    assert out["MIX"].top_driver == "avg_null_rate"  # tie .15/.15 -> first in weight order
    assert out["MIX"].risk_tier == "MEDIUM"


def test_components_sum_to_composite_and_range(spark):
    import random
    rnd = random.Random(7)
    rows = [(f"D{i}", rnd.random(), rnd.random(), rnd.random() * 100, float(rnd.randint(0, 30)), 0, "LOW")
            for i in range(200)]
    out = score_domains(_clustered(spark, rows), ScoreParams()).collect()
    w = ScoreParams().weights
    for r in out:
        total = sum(r[f"score_{c}"] * w[c] for c in FEATURES) * 100
        assert abs(total - r.composite_score) <= 0.05 + 1e-9
        assert 0 <= r.composite_score <= 100
        assert r.risk_tier in TIER_LABELS


def test_risk_scores_columns_and_run_date(spark):
    df = _clustered(spark, [("A", 0.1, 0.1, 1.0, 0.0, 2, "HIGH")])
    out = risk_scores(df, run_date="2024-05-01")
    assert out.columns == ["domain_id", "run_date", "composite_score", "cluster_label", "risk_tier", "top_driver"]
    assert str(out.first().run_date) == "2024-05-01"
    assert out.select(F.col("cluster_label")).first()[0] == 2


def test_missing_columns_raise(spark):
    df = spark.createDataFrame([("A", 0.1)], "domain_id string, avg_null_rate double")
    with pytest.raises(ValueError):
        score_domains(df)
