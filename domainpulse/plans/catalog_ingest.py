"""Catalog entries for the append-safe loads and surrogate keys.

The stored side is history the tables already imply: metric rows before
the trailing window (a re-delivered full file must add only the window's
rows), and the domains that have reported events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domainpulse.config import EVENTS
from domainpulse.operators import ingest
from domainpulse.operators.kpi import window_start
from domainpulse.plans import bridges
from domainpulse.plans.catalog import query
from domainpulse.session import cut_lineage


def delivered(spark, base) -> DataFrame:
    """The metrics, profiled once: both sides of a load and its counts read this."""
    return cut_lineage(bridges.events_metrics(spark, base))


def stored_history(m: DataFrame) -> DataFrame:
    return m.where(F.col("snapshot_date") < window_start(m, EVENTS.window_days))


def incoming_domains(spark, base) -> DataFrame:
    """Every domain twice: the second delivery has other names, and the first arrival must win."""
    cust = bridges.events_domains(spark, base)
    again = cust.withColumn("domain_name", F.concat("domain_name", F.lit(" (again)")))
    arrival = lambda delivery: F.struct(F.lit(delivery).alias("delivery"), F.monotonically_increasing_id().alias("row"))
    return again.withColumn("arrival", arrival(2)).unionByName(cust.withColumn("arrival", arrival(1)))


def stored_domains(spark, base) -> DataFrame:
    reporting = bridges.events_metrics(spark, base).select("domain_id")
    return bridges.events_domains(spark, base).join(reporting, "domain_id", "left_semi")


@query("ingest_new_metrics")
def q_ingest_new_metrics(spark, base):
    incoming = delivered(spark, base)
    return ingest.new_metrics(incoming, stored_history(incoming))


@query("ingest_new_domains")
def q_ingest_new_domains(spark, base):
    return ingest.new_domains(incoming_domains(spark, base), stored_domains(spark, base))


@query("ingest_counts")
def q_ingest_counts(spark, base):
    incoming = delivered(spark, base)
    stored = stored_history(incoming)
    return ingest.ingest_counts(stored, incoming, ingest.new_metrics(incoming, stored))


@query("surrogate_key")
def q_surrogate_key(spark, base):
    return ingest.assign_metric_ids(delivered(spark, base))
