"""The full chain as plain function composition.

validate -> KPI rollup -> gaps -> features -> k-means -> scores.  Frames are
passed along (no file hand-offs between stages); the KPI rollup, which
every later stage reads, is checkpointed into the shared checkpoint folder
so its lineage back to the raw scan is cut; features and standardised
features are projections of it.  Nothing is cached.  Checkpoints last as
long as the result is read: ``session.intermediates`` bounds their life.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domainpulse.config import PipelineConfig, REFERENCE
from domainpulse.operators import cluster as cluster_ops
from domainpulse.operators import features as feature_ops
from domainpulse.operators import gaps as gap_ops
from domainpulse.operators import kpi as kpi_ops
from domainpulse.operators import quality
from domainpulse.operators import score as score_ops
from domainpulse.session import cut_lineage
from domainpulse.sources.files import read_domains_csv, read_metrics_csv


@dataclass
class ChainResult:
    report: DataFrame | None
    kpi: DataFrame
    gaps: DataFrame
    features: DataFrame
    scaled: DataFrame
    clustered: DataFrame
    scores: DataFrame
    centers: list
    cost: float | None
    seed: int | None
    alerts: DataFrame | None = None


def run_chain(
    domains: DataFrame,
    metrics: DataFrame,
    cfg: PipelineConfig = REFERENCE,
    centers=None,
    run_date: str | dt.date | None = None,
    validate: bool = True,
    report: DataFrame | None = None,
    dates: DataFrame | None = None,
) -> ChainResult:
    """Score every domain of ``metrics``.

    ``centers`` (k lists in standardised space) skips the k-means fit.
    ``dates``: as in ``kpi.window_filter``; the rollup is then the one reader of ``metrics``.
    With ``validate`` the checks run first (unless a ``report`` is passed)
    and a FAILED issue raises RuntimeError.
    """
    if validate:
        report = report if report is not None else quality.validation_report(domains, metrics)
        quality.raise_on_failure(report)
    kpi = cut_lineage(kpi_ops.kpi_summary(metrics, cfg.window_days, dates))
    gaps = gap_ops.gap_candidates(kpi, domains, cfg.gaps)
    feats = feature_ops.build_features(kpi)
    scaled = feature_ops.standardise(feats)
    cost = seed = None
    if centers is None:
        centers, cost, seed = cluster_ops.fit_kmeans(scaled, cfg.cluster)
    clustered = cluster_ops.label_features(feats, centers)
    scores = score_ops.risk_scores(clustered, cfg.score, run_date)
    return ChainResult(report, kpi, gaps, feats, scaled, clustered, scores, centers, cost, seed)


def run_from_files(spark: SparkSession, domains_csv: str, metrics_csv: str, cfg: PipelineConfig = REFERENCE,
                   **kwargs) -> ChainResult:
    """The chain over the two delivered CSV files (domains, coverage metrics).

    The metrics are parsed once into the checkpoint folder: validation and
    the rollup read them several times, which would re-parse the CSV each time.
    """
    metrics = cut_lineage(read_metrics_csv(spark, metrics_csv))
    return run_chain(read_domains_csv(spark, domains_csv), metrics, cfg, **kwargs)


def publish_views(result: ChainResult) -> None:
    """Idempotent publication of the rollup and gap views (replace if present)."""
    result.kpi.createOrReplaceTempView("domain_kpi_summary")
    result.gaps.createOrReplaceTempView("coverage_gap_candidates")


def export_outputs(result: ChainResult, out_dir: str, fmt: str = "csv") -> None:
    """The four stage outputs, overwritten on every run."""
    from domainpulse.sources.sinks import export

    base = out_dir.rstrip("/")
    export(result.scaled, f"{base}/processed/risk_features", fmt)
    export(result.features, f"{base}/processed/risk_features_raw", fmt)
    export(result.clustered, f"{base}/processed/clustered_risk_features", fmt)
    export(result.scores, f"{base}/exports/risk_scores", fmt)


def ingest_stage(spark: SparkSession, domains_csv: str, metrics_csv: str, store_dir: str,
                 strict_fk: bool = False) -> dict[str, int]:
    """I4 + W1 + W3: load domains first, then metrics, each append-safe, and audit both.

    ``strict_fk`` rejects a metric load that references unknown domains.
    A failure is audited as ``ingest``/FAILED before it is re-raised.
    """
    from domainpulse import schemas
    from domainpulse.sources import sinks

    base = store_dir.rstrip("/")
    audit = f"{base}/audit_log"
    try:
        incoming = read_domains_csv(spark, domains_csv, arrival="arrival")
        n_domains = sinks.append_domains(spark, incoming, f"{base}/domains")
        sinks.append_audit(spark, sinks.audit_event(spark, "ingest.domains", "SUCCESS", n_domains), audit)
        n_metrics = sinks.append_metrics(spark, read_metrics_csv(spark, metrics_csv), f"{base}/coverage_metrics",
                                         sinks.read_store(spark, f"{base}/domains", schemas.DOMAINS), strict_fk)
        sinks.append_audit(spark, sinks.audit_event(spark, "ingest.coverage_metrics", "SUCCESS", n_metrics), audit)
    except Exception as exc:
        sinks.append_audit(spark, sinks.audit_event(spark, "ingest", "FAILED", 0, str(exc)), audit)
        raise
    return {"domains": n_domains, "coverage_metrics": n_metrics}


def run_stored(spark: SparkSession, store_dir: str, cfg: PipelineConfig = REFERENCE, **kwargs) -> ChainResult:
    """The chain over the stores written by ``ingest_stage``; validation is audited.

    The stores are checked as their files are: a column that no file holds is
    a FAILED issue.  The scores are kept per run (``risk_scores``, by
    ``run_date``); ``alerts`` compares them with the run stored before, and
    is appended to ``risk_alerts``.
    """
    from domainpulse import schemas
    from domainpulse.operators import trend
    from domainpulse.sources import sinks

    base = store_dir.rstrip("/")
    domains = sinks.read_as_found(spark, f"{base}/domains", schemas.DOMAINS)
    metrics = sinks.read_as_found(spark, f"{base}/coverage_metrics", schemas.METRICS)
    report = quality.validation_report(domains, metrics)
    sinks.append_audit(spark, report, f"{base}/audit_log")
    result = run_chain(domains, metrics, cfg, validate=True, report=report, **kwargs)
    # materialised: the run's rows are compared and stored as one result
    result.scores = cut_lineage(result.scores)
    run_date = result.scores.agg(F.max("run_date")).first()[0]
    stored = sinks.read_store(spark, f"{base}/risk_scores", schemas.RISK_SCORES)
    result.alerts = cut_lineage(trend.alerts_of_run(result.scores, stored, run_date))
    sinks.append_runs(result.scores, f"{base}/risk_scores")
    sinks.append_runs(result.alerts, f"{base}/risk_alerts")
    return result
