"""Coverage-gap detection: KPI rollup joined to domains, thresholded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domainpulse.config import GapParams
from domainpulse.functions.tiers import severity_label

GAP_COLUMNS = (
    "domain_id", "domain_name", "owner_team", "data_source",
    "latest_snapshot", "snapshot_count", "avg_null_rate", "avg_stale_rate",
    "avg_update_lag_hrs", "total_missing_fields", "max_null_rate",
    "max_stale_rate", "max_update_lag_hrs",
)


def gap_candidates(kpi: DataFrame, domains: DataFrame, params: GapParams = GapParams(),
                   only_breaches: bool = True) -> DataFrame:
    """Domains breaching at least one threshold (strict, on rounded averages).

    The inner join drops rollup rows without a known domain (orphans and
    the null-id group).  No broadcast hint: the domain table grows with the
    data, so AQE picks a broadcast only when the measured side is small.
    """
    lag = F.col("avg_update_lag_hrs") > F.lit(params.lag_hrs)
    nulls = F.col("avg_null_rate") > F.lit(params.null_rate)
    stale = F.col("avg_stale_rate") > F.lit(params.stale_rate)
    joined = kpi.join(domains.select("domain_id", "domain_name", "owner_team", "data_source"), "domain_id")
    if only_breaches:
        joined = joined.where(lag | nulls | stale)
    flagged = joined.select(
        *GAP_COLUMNS,
        F.when(lag, 1).otherwise(0).alias("flag_stale_lag"),
        F.when(nulls, 1).otherwise(0).alias("flag_high_nulls"),
        F.when(stale, 1).otherwise(0).alias("flag_high_stale"),
    )
    breaches = F.col("flag_stale_lag") + F.col("flag_high_nulls") + F.col("flag_high_stale")
    return flagged.withColumn("breach_count", breaches).withColumn(
        "gap_severity", severity_label(F.col("breach_count"))
    )


def rank_gaps(gaps: DataFrame) -> DataFrame:
    """Most breaches first, then longest lag, then domain id."""
    return gaps.orderBy(F.col("breach_count").desc(), F.col("avg_update_lag_hrs").desc(), F.col("domain_id"))
