"""Catalog entries for KPI/score trends and alerts (events bridge)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from domainpulse import schemas
from domainpulse.config import DEMO_CENTROIDS, EVENTS
from domainpulse.operators import cluster, features, kpi, score, trend
from domainpulse.plans import bridges
from domainpulse.plans.catalog import query, stored_kpi
from domainpulse.session import cut_lineage, run_folder
from domainpulse.sources import sinks

#: Days between the last day of the metrics and the runs that ``run_alerts`` stores.
RUN_AGES = (14, 7, 0)


def events_trend(spark, base):
    rolling = trend.kpi_rolling(bridges.events_metrics(spark, base), EVENTS.window_days)
    return trend.score_trend(rolling, EVENTS.score)


@query("kpi_rolling")
def q_kpi_rolling(spark, base):
    return trend.kpi_rolling(bridges.events_metrics(spark, base), EVENTS.window_days)


@query("score_trend")
def q_score_trend(spark, base):
    return events_trend(spark, base)


@query("risk_alerts")
def q_risk_alerts(spark, base):
    return trend.risk_alerts(events_trend(spark, base))


@query("risk_alerts_latest")
def q_risk_alerts_latest(spark, base):
    return trend.latest_alerts(events_trend(spark, base))


@query("run_alerts")
def q_run_alerts(spark, base):
    """Weekly runs of the whole chain, stored per run; alerts of each against the run stored before it."""
    metrics = cut_lineage(bridges.events_metrics(spark, base))
    store = run_folder(spark, "risk_scores")
    last = metrics.agg(F.max("snapshot_date")).first()[0]
    for age in RUN_AGES:
        run_date = last - dt.timedelta(days=age)
        rollup = stored_kpi(kpi.kpi_summary(metrics.where(F.col("snapshot_date") <= F.lit(run_date)), EVENTS.window_days))
        clustered = cluster.label_features(features.build_features(rollup), DEMO_CENTROIDS)
        sinks.append_runs(score.risk_scores(clustered, EVENTS.score, run_date), store)
    return trend.run_alerts(sinks.read_store(spark, store, schemas.RISK_SCORES))
