"""Trends: KPIs and scores as of each day, change since the previous day, alerts.

Windows are partitioned by domain over the daily metric rows (one row per
domain per day after profiling), so a window partition holds at most the
domain's days of history, never a share of the raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from domainpulse.config import FEATURES, ScoreParams
from domainpulse.functions.rounding import round_half_up
from domainpulse.functions.tiers import band_tier, tier_rank, top_driver
from domainpulse.operators.score import add_components, composite, contributions


def daily(metrics: DataFrame) -> DataFrame:
    """One row per (domain, day): sums and counts (copies of a key collapse map-side)."""
    return metrics.groupBy("domain_id", "snapshot_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("null_rate").alias("s_null"), F.count("null_rate").alias("c_null"),
        F.sum("stale_rate").alias("s_stale"), F.count("stale_rate").alias("c_stale"),
        F.sum("update_lag_hrs").alias("s_lag"), F.count("update_lag_hrs").alias("c_lag"),
        F.sum("missing_fields").alias("s_missing"),
    )


def kpi_rolling(metrics: DataFrame, window_days: int = 7) -> DataFrame:
    """Trailing ``window_days`` KPIs per domain as of each reported day.

    Averages are sums over counts of the daily rows in the frame, equal to
    averaging the metric rows themselves; the window sees one row per day.
    """
    w = (Window.partitionBy("domain_id").orderBy(F.unix_date("snapshot_date"))
         .rangeBetween(-(window_days - 1), 0))

    def avg(s: str, c: str) -> F.Column:
        return F.sum(s).over(w) / F.sum(c).over(w)

    return daily(metrics).select(
        "domain_id", "snapshot_date",
        F.sum("n").over(w).alias("snapshot_count"),
        round_half_up(avg("s_null", "c_null"), 4).alias("avg_null_rate"),
        round_half_up(avg("s_stale", "c_stale"), 4).alias("avg_stale_rate"),
        round_half_up(avg("s_lag", "c_lag"), 2).alias("avg_update_lag_hrs"),
        F.sum("s_missing").over(w).alias("total_missing_fields"),
    )


def score_trend(rolling: DataFrame, params: ScoreParams = ScoreParams()) -> DataFrame:
    """Composite score and score tier per domain per day, with day-over-day change."""
    feats = rolling.select(
        "domain_id", "snapshot_date",
        F.col("avg_null_rate").cast("double").alias(FEATURES[0]),
        F.col("avg_stale_rate").cast("double").alias(FEATURES[1]),
        F.col("avg_update_lag_hrs").cast("double").alias(FEATURES[2]),
        F.col("total_missing_fields").cast("double").alias(FEATURES[3]),
    )
    scored = add_components(feats, params).select(
        "domain_id", "snapshot_date",
        composite(params).alias("composite_score"),
        top_driver(contributions(params)).alias("top_driver"),
    ).withColumn("risk_tier", band_tier("composite_score", params.band_mode))
    prev = Window.partitionBy("domain_id").orderBy("snapshot_date")
    return scored.select(
        "*",
        F.lag("composite_score").over(prev).alias("prev_score"),
        F.lag("risk_tier").over(prev).alias("prev_tier"),
    ).withColumn("score_change", round_half_up(F.col("composite_score") - F.col("prev_score"), 1))


def risk_alerts(trend: DataFrame) -> DataFrame:
    """Alert rows: HIGH/CRITICAL tier, or a tier higher than the day before."""
    high = F.col("risk_tier").isin("HIGH", "CRITICAL")
    rose = F.col("prev_tier").isNotNull() & (tier_rank("risk_tier") > tier_rank("prev_tier"))
    return trend.where(high | rose).select(
        "domain_id", "snapshot_date", "composite_score", "risk_tier", "prev_tier", "top_driver",
        F.concat_ws(",", F.when(high, F.lit("high_tier")), F.when(rose, F.lit("tier_rose"))).alias("alert_reason"),
    )


def previous_runs(scores: DataFrame) -> DataFrame:
    """(run_date, prev_run): every stored run and the run stored before it (one row per run, bounded by runs)."""
    order = Window.orderBy("run_date")
    return scores.select("run_date").distinct().withColumn("prev_run", F.lag("run_date").over(order))


def run_over_run(current: DataFrame, earlier: DataFrame) -> DataFrame:
    """Scores of ``current`` (with ``prev_run``) next to the same domain's scores in that run.

    A domain without id matches the domain without id.  A domain that the
    run before did not score has no previous score.
    """
    before = earlier.select(
        F.col("domain_id").alias("_domain"), F.col("run_date").alias("_run"), F.col("composite_score").alias("prev_score"),
        F.col("risk_tier").alias("prev_tier"), F.col("top_driver").alias("prev_driver"))
    same = current["domain_id"].eqNullSafe(before["_domain"]) & (current["prev_run"] == before["_run"])
    return current.join(before, same, "left").drop("_domain", "_run").withColumn(
        "score_change", round_half_up(F.col("composite_score") - F.col("prev_score"), 1))


def run_alerts(scores: DataFrame) -> DataFrame:
    """Alert rows over all stored runs: HIGH/CRITICAL tier, or a tier higher than in the previous stored run."""
    runs = previous_runs(scores)
    return _alerts(run_over_run(scores.join(F.broadcast(runs), "run_date"), scores))


def alerts_of_run(scores: DataFrame, stored: DataFrame, run_date) -> DataFrame:
    """Alert rows of one run, ``scores``, against the run stored last before ``run_date``.

    Only that run's partition of the store is read: its date comes from the partition values.
    """
    last = stored.where(F.col("run_date") < F.lit(run_date).cast("date")).agg(F.max("run_date")).first()[0]
    previous = stored.where(F.col("run_date") == F.lit(last).cast("date"))
    return _alerts(run_over_run(scores.withColumn("prev_run", F.lit(last).cast("date")), previous))


def _alerts(compared: DataFrame) -> DataFrame:
    high = F.col("risk_tier").isin("HIGH", "CRITICAL")
    rose = F.col("prev_tier").isNotNull() & (tier_rank("risk_tier") > tier_rank("prev_tier"))
    return compared.where(high | rose).select(
        "domain_id", "run_date", "prev_run", "composite_score", "prev_score", "score_change", "risk_tier", "prev_tier",
        "top_driver", "prev_driver",
        F.concat_ws(",", F.when(high, F.lit("high_tier")), F.when(rose, F.lit("tier_rose"))).alias("alert_reason"))


def latest_alerts(trend: DataFrame) -> DataFrame:
    """Alerts as of each domain's latest reported day (max per domain, a partial aggregate)."""
    last = trend.groupBy("domain_id").agg(F.max("snapshot_date").alias("snapshot_date"))
    return risk_alerts(trend.join(last, ["domain_id", "snapshot_date"], "left_semi"))
