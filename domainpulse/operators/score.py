"""Composite risk score, score tier, tier reconciliation and top driver.

One projection over the clustered features: no shuffle, no Python.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from domainpulse.config import FEATURES, ScoreParams
from domainpulse.functions.rounding import round_half_even
from domainpulse.functions.tiers import band_tier, reconcile_tier, top_driver
from domainpulse.schemas import require_columns

SCORE_COLUMNS = ("domain_id", "run_date", "composite_score", "cluster_label", "risk_tier", "top_driver")


def component(x: Column, ceiling: float) -> Column:
    """x / ceiling capped at 1 (no lower clip); null stays null."""
    ratio = x / F.lit(float(ceiling))
    return F.when(x.isNotNull(), F.least(ratio, F.lit(1.0)))


def add_components(df: DataFrame, params: ScoreParams = ScoreParams()) -> DataFrame:
    return df.select("*", *[component(F.col(c), params.ceilings[c]).alias(f"score_{c}") for c in FEATURES])


def composite(params: ScoreParams = ScoreParams()) -> Column:
    """sum(weight * component) * 100, banker's rounding to one decimal."""
    total = None
    for c in FEATURES:
        term = F.col(f"score_{c}") * F.lit(params.weights[c])
        total = term if total is None else total + term
    return round_half_even(total * F.lit(100), 1)


def contributions(params: ScoreParams = ScoreParams()) -> dict[str, Column]:
    return {c: F.col(f"score_{c}") * F.lit(params.weights[c]) for c in FEATURES}


def score_domains(clustered: DataFrame, params: ScoreParams = ScoreParams()) -> DataFrame:
    """Adds components, composite_score, score/cluster/final tiers, top_driver.

    ``clustered`` carries the four raw features and the cluster tier in
    ``risk_tier``; the final tier replaces it.
    """
    require_columns(clustered, [*FEATURES, "domain_id", "cluster_label", "risk_tier"], "clustered features")
    df = add_components(clustered.withColumnRenamed("risk_tier", "cluster_tier"), params)
    df = df.withColumn("composite_score", composite(params))
    df = df.withColumn("score_tier", band_tier(F.col("composite_score"), params.band_mode))
    df = df.withColumn("risk_tier", reconcile_tier("score_tier", "cluster_tier"))
    return df.withColumn("top_driver", top_driver(contributions(params)))


def risk_scores(clustered: DataFrame, params: ScoreParams = ScoreParams(),
                run_date: str | dt.date | None = None) -> DataFrame:
    """Final table: domain_id, run_date, composite_score, cluster_label, risk_tier, top_driver."""
    run = F.current_date() if run_date is None else F.lit(str(run_date)).cast("date")
    return score_domains(clustered, params).withColumn("run_date", run).select(*SCORE_COLUMNS)


def rank_scores(scores: DataFrame) -> DataFrame:
    """Highest score first; domain id breaks ties."""
    return scores.orderBy(F.col("composite_score").desc(), F.col("domain_id"))
