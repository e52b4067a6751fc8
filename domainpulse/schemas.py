"""Table definitions and the source contract (column presence / projection)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

DOMAINS = T.StructType([
    T.StructField("domain_id", T.StringType()),
    T.StructField("domain_name", T.StringType()),
    T.StructField("owner_team", T.StringType()),
    T.StructField("data_source", T.StringType()),
])

# As delivered in files: metric_id is dropped on load, dates arrive as text.
METRICS_FILE = T.StructType([
    T.StructField("metric_id", T.LongType()),
    T.StructField("domain_id", T.StringType()),
    T.StructField("snapshot_date", T.StringType()),
    T.StructField("total_records", T.LongType()),
    T.StructField("null_rate", T.DoubleType()),
    T.StructField("stale_rate", T.DoubleType()),
    T.StructField("update_lag_hrs", T.DoubleType()),
    T.StructField("missing_fields", T.LongType()),
    T.StructField("created_at", T.StringType()),
])

# Stored fact table (one row per domain per day).
METRICS = T.StructType([
    T.StructField("domain_id", T.StringType()),
    T.StructField("snapshot_date", T.DateType()),
    T.StructField("total_records", T.LongType()),
    T.StructField("null_rate", T.DoubleType()),
    T.StructField("stale_rate", T.DoubleType()),
    T.StructField("update_lag_hrs", T.DoubleType()),
    T.StructField("missing_fields", T.LongType()),
    T.StructField("created_at", T.TimestampType()),
])

AUDIT_LOG = T.StructType([
    T.StructField("run_id", T.LongType()),
    T.StructField("run_ts", T.TimestampType()),
    T.StructField("stage", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_affected", T.LongType()),
    T.StructField("notes", T.StringType()),
])

# A data-quality issue before it is stamped into the audit log.
ISSUE = T.StructType([
    T.StructField("check_order", T.IntegerType()),
    T.StructField("stage", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_affected", T.LongType()),
    T.StructField("notes", T.StringType()),
])

RISK_SCORES = T.StructType([
    T.StructField("domain_id", T.StringType()),
    T.StructField("run_date", T.DateType()),
    T.StructField("composite_score", T.DoubleType()),
    T.StructField("cluster_label", T.IntegerType()),
    T.StructField("risk_tier", T.StringType()),
    T.StructField("top_driver", T.StringType()),
])

TABLES = {
    "domains": DOMAINS,
    "coverage_metrics": METRICS,
    "audit_log": AUDIT_LOG,
    "risk_scores": RISK_SCORES,
}


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [c for c in required if c not in present]


def require_columns(df: DataFrame, required: Iterable[str], what: str) -> DataFrame:
    """Source contract: raise before any job runs if a column is absent."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"{what} is missing columns: {missing}")
    return df


def conform(df: DataFrame, required: Iterable[str], what: str) -> DataFrame:
    """Check the contract, then keep only the contract's columns, in order."""
    cols = list(required)
    return require_columns(df, cols, what).select(*cols)
