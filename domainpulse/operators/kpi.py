"""Trailing-window KPI rollup per domain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domainpulse.functions.missing import known
from domainpulse.functions.rounding import round_half_up

FEATURE_SOURCE_COLUMNS = ("avg_null_rate", "avg_stale_rate", "avg_update_lag_hrs", "total_missing_fields")


def window_start(metrics: DataFrame, window_days: int = 7):
    """Scalar subquery: first day of the window, anchored on the global max."""
    return metrics.select(F.date_sub(F.max("snapshot_date"), window_days - 1)).scalar()


def window_filter(metrics: DataFrame, window_days: int = 7, dates: DataFrame | None = None) -> DataFrame:
    """Rows of the last ``window_days`` calendar days of the whole table.

    ``dates``: a frame with the same largest ``snapshot_date`` that is cheaper to read, such as the
    fact table of a profile over a join.

    The anchor is one uncorrelated scalar subquery; the predicate sits on a
    grouping key of any upstream profile, so Catalyst pushes it below that
    aggregate (and to partition pruning on a date-partitioned table).
    """
    return metrics.where(F.col("snapshot_date") >= window_start(metrics if dates is None else dates, window_days))


def kpi_summary(metrics: DataFrame, window_days: int = 7, dates: DataFrame | None = None) -> DataFrame:
    """One row per domain over the trailing window (nulls form a group; values that are not numbers are missing)."""
    return window_filter(metrics, window_days, dates).groupBy("domain_id").agg(
        F.max("snapshot_date").alias("latest_snapshot"),
        F.count(F.lit(1)).alias("snapshot_count"),
        round_half_up(F.avg(known("null_rate")), 4).alias("avg_null_rate"),
        round_half_up(F.avg(known("stale_rate")), 4).alias("avg_stale_rate"),
        round_half_up(F.avg(known("update_lag_hrs")), 2).alias("avg_update_lag_hrs"),
        F.sum("missing_fields").alias("total_missing_fields"),
        round_half_up(F.max(known("null_rate")), 4).alias("max_null_rate"),
        round_half_up(F.max(known("stale_rate")), 4).alias("max_stale_rate"),
        round_half_up(F.max(known("update_lag_hrs")), 2).alias("max_update_lag_hrs"),
    )


def rank_kpi(kpi: DataFrame) -> DataFrame:
    """Worst null rate first (sink-side sort; domain id breaks ties)."""
    return kpi.orderBy(F.col("avg_null_rate").desc(), F.col("domain_id").asc())


def feature_input(kpi: DataFrame) -> DataFrame:
    """The pruned view the feature stage reads, ordered by domain."""
    return kpi.select("domain_id", *FEATURE_SOURCE_COLUMNS).orderBy("domain_id")
