"""Quality profiler: a raw table -> daily ``coverage_metrics`` rows.

One hash aggregate keyed by (domain, day).  Partial aggregation runs before
the shuffle, so a domain holding a large share of the raw rows is combined
map-side and never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def share(pred: Column) -> Column:
    """Fraction of rows where ``pred`` holds (null counts as false)."""
    return F.avg(F.when(pred, F.lit(1.0)).otherwise(F.lit(0.0)))


def profile(
    raw: DataFrame,
    domain_id: Column,
    event_time: Column,
    null_when: Column,
    stale_when: Column,
    update_lag: Column,
    missing_fields: Column,
) -> DataFrame:
    """Daily metrics per domain.

    ``null_when``/``stale_when`` are row predicates whose share becomes
    ``null_rate``/``stale_rate``; ``update_lag`` and ``missing_fields`` are
    aggregate expressions evaluated per (domain, day).
    """
    return raw.groupBy(
        domain_id.alias("domain_id"),
        F.to_date(event_time).alias("snapshot_date"),
    ).agg(
        F.count(F.lit(1)).alias("total_records"),
        share(null_when).alias("null_rate"),
        share(stale_when).alias("stale_rate"),
        update_lag.cast("double").alias("update_lag_hrs"),
        missing_fields.cast("long").alias("missing_fields"),
    )
