"""Catalog entries for the data-quality checks and the audit rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from domainpulse.operators import quality as dq
from domainpulse.plans import bridges
from domainpulse.plans.catalog import query
from domainpulse.session import cut_lineage

ENRICHED_NULL_COLUMNS = ("domain_id", "domain_name", "owner_team", "data_source", "null_rate", "update_lag_hrs")


def lineitem_enriched(spark, base) -> DataFrame:
    """Metric rows with their domain attributes (null where the domain is unknown)."""
    return bridges.lineitem_metrics(spark, base).join(bridges.lineitem_domains(spark, base), "domain_id", "left")


def stored_metrics(metrics: DataFrame) -> DataFrame:
    """Metrics materialised once before several checks read them.

    Each check prunes to its own columns, so over a raw bridge every branch
    would re-profile the raw tables; the daily metrics are far smaller.
    """
    return cut_lineage(metrics)


@query("dq_duplicate_keys")
def q_dq_duplicate_keys(spark, base):
    return dq.check_duplicate_keys(bridges.events_keys(spark, base))


@query("dq_duplicate_pairs")
def q_dq_duplicate_pairs(spark, base):
    return dq.duplicate_groups(bridges.events_keys(spark, base))


@query("dq_nulls")
def q_dq_nulls(spark, base):
    return dq.check_nulls(lineitem_enriched(spark, base), "coverage_metrics_enriched", ENRICHED_NULL_COLUMNS)


@query("dq_ranges")
def q_dq_ranges(spark, base):
    return dq.check_numeric_ranges(bridges.lineitem_metrics(spark, base))


@query("dq_orphans")
def q_dq_orphans(spark, base):
    return dq.check_referential_integrity(bridges.lineitem_metrics(spark, base),
                                          bridges.lineitem_domains(spark, base))


@query("dq_orphan_ids")
def q_dq_orphan_ids(spark, base):
    return dq.orphan_ids(bridges.lineitem_metrics(spark, base), bridges.lineitem_domains(spark, base))


@query("dq_all_issues")
def q_dq_all_issues(spark, base):
    return dq.all_issues(bridges.lineitem_domains(spark, base), stored_metrics(bridges.lineitem_metrics(spark, base)))


@query("dq_report")
def q_dq_report(spark, base):
    return dq.validation_report(bridges.events_domains(spark, base), stored_metrics(bridges.events_metrics(spark, base)))


@query("dq_report_lineitem")
def q_dq_report_lineitem(spark, base):
    return dq.validation_report(bridges.lineitem_domains(spark, base),
                                stored_metrics(bridges.lineitem_metrics(spark, base)))


@query("dq_status_counts")
def q_dq_status_counts(spark, base):
    return dq.status_counts(q_dq_report_lineitem(spark, base))


@query("audit_rows")
def q_audit_rows(spark, base):
    return dq.audit_rows(q_dq_report_lineitem(spark, base)).drop("run_ts")
