"""Catalog entries for deliveries, stores and exports: tables leave the engine as files and come back.

The deliveries are the profiled tables written as CSV under the shared
checkpoint folder, in files of two different headers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domainpulse import schemas
from domainpulse.config import DEMO_CENTROIDS, EVENTS, REQUIRED_DOMAIN_COLUMNS, REQUIRED_METRIC_COLUMNS
from domainpulse.operators.gaps import rank_gaps
from domainpulse.operators.ingest import new_domains
from domainpulse.plans import bridges
from domainpulse.plans.catalog import RUN_DATE, query
from domainpulse.plans.chain import export_outputs, ingest_stage, publish_views, run_chain, run_stored
from domainpulse.session import cut_lineage, run_folder
from domainpulse.sources import files, sinks
from domainpulse.streaming.incremental import incremental_ingest


def deliver(df: DataFrame, folder: str, key: str = "domain_id") -> str:
    """``df`` as CSV files: half of the keys as they are, the others with the columns reversed and one more."""
    half = F.pmod(F.xxhash64(key), F.lit(2)) == 0
    sinks.export(df.where(half), f"{folder}/a", "csv")
    turned = df.where(~half).select(F.lit("n/a").alias("remark"), *reversed(df.columns))
    sinks.export(turned, f"{folder}/b", "csv")
    return f"{folder}/*"


def delivered_metrics(spark: SparkSession, base: str) -> tuple[DataFrame, str]:
    metrics = cut_lineage(bridges.events_metrics(spark, base))
    return metrics, deliver(metrics, run_folder(spark, "delivered-metrics"))


@query("csv_metrics")
def q_csv_metrics(spark, base):
    """The metrics from files of two headers, dates from text."""
    return files.read_metrics_csv(spark, delivered_metrics(spark, base)[1]).select(*REQUIRED_METRIC_COLUMNS)


@query("csv_domains")
def q_csv_domains(spark, base):
    """The domains from files of two headers, the first arrival of each id."""
    path = deliver(bridges.events_domains(spark, base), run_folder(spark, "delivered-domains"))
    none = spark.createDataFrame([], schemas.DOMAINS)
    return new_domains(files.read_domains_csv(spark, path, arrival="arrival"), none).select(*REQUIRED_DOMAIN_COLUMNS)


@query("stored_metrics")
def q_stored_metrics(spark, base):
    """Three overlapping loads; the store holds every row once."""
    metrics = cut_lineage(bridges.events_metrics(spark, base))
    store = run_folder(spark, "stored-metrics")
    for part in (metrics.where("dayofmonth(snapshot_date) % 3 <> 0"), metrics, metrics):
        sinks.append_metrics(spark, part, store)
    return sinks.read_store(spark, store, schemas.METRICS).select(*REQUIRED_METRIC_COLUMNS)


@query("streamed_metrics")
def q_streamed_metrics(spark, base):
    """Two runs of the stream over deliveries that overlap; the store holds every row once."""
    metrics = cut_lineage(bridges.events_metrics(spark, base))
    landing, store, checkpoint = (run_folder(spark, f"streamed-{x}") for x in ("landing", "store", "checkpoint"))
    for run, part in enumerate((metrics.where("dayofmonth(snapshot_date) % 3 <> 0"), metrics)):
        deliver(part, f"{landing}/{run}")
        incremental_ingest(spark, f"{landing}/*/*", store, checkpoint)
    return sinks.read_store(spark, store, schemas.METRICS).select(*REQUIRED_METRIC_COLUMNS)


@query("stored_chain_scores")
def q_stored_chain_scores(spark, base):
    """Files are ingested (domains first), the stores validated and scored, and the run's scores stored."""
    _, metrics_csv = delivered_metrics(spark, base)
    domains_csv = deliver(bridges.events_domains(spark, base), run_folder(spark, "delivered-domains"))
    store = run_folder(spark, "stores")
    ingest_stage(spark, domains_csv, metrics_csv, store)
    run_stored(spark, store, EVENTS, centers=DEMO_CENTROIDS, run_date=RUN_DATE)
    return sinks.read_store(spark, f"{store}/risk_scores", schemas.RISK_SCORES)


def _run(spark, base):
    metrics = cut_lineage(bridges.events_metrics(spark, base))
    return run_chain(bridges.events_domains(spark, base), metrics, EVENTS, centers=DEMO_CENTROIDS, run_date=RUN_DATE, validate=False)


@query("exported_scores")
def q_exported_scores(spark, base):
    """The chain's outputs exported as CSV, twice (the second overwrites the first), and the scores read back."""
    out = run_folder(spark, "exports")
    result = _run(spark, base)
    for _ in range(2):
        export_outputs(result, out)
    return spark.read.schema(schemas.RISK_SCORES).option("header", True).csv(f"{out}/exports/risk_scores")


@query("published_gaps")
def q_published_gaps(spark, base):
    """The gap view, published twice."""
    result = _run(spark, base)
    for _ in range(2):
        publish_views(result)
    return rank_gaps(spark.table("coverage_gap_candidates"))
