"""Sinks: append-safe fact store, overwriting exports, audit log append."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from domainpulse import schemas
from domainpulse.operators.ingest import new_domains, new_metrics
from domainpulse.session import cut_lineage, path_exists


def read_store(spark: SparkSession, path: str, schema) -> DataFrame:
    """A stored table, or an empty frame with its schema if absent."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_as_found(spark: SparkSession, path: str, schema) -> DataFrame:
    """A stored table with those of its schema's columns that its files hold, in order; an absent table is empty.

    ``read_store`` reads a column that no file holds as nulls.  Here the files'
    own footers tell the columns (merged over all files, a distributed pass
    over the footers), so that a check of the contract sees what is missing.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    found = spark.read.option("mergeSchema", "true").parquet(path)
    return found.select(*[f.name for f in schema.fields if f.name in found.columns])


def with_metric_columns(df: DataFrame) -> DataFrame:
    """Stored metric columns in order; a missing created_at becomes the load time."""
    if "created_at" not in df.columns:
        df = df.withColumn("created_at", F.current_timestamp())
    return df.select(*schemas.METRICS.fieldNames())


def stored_for_dates(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """The stored rows on the snapshot dates of ``incoming`` (partition pruning).

    A key can only match on its own date, so the other date partitions of
    the store never need to be read: a load costs what it delivers, not what
    the history holds.  The distinct dates are one small aggregate, bounded
    by calendar days; a null date keeps the null partition.
    """
    dates = [r[0] for r in incoming.select("snapshot_date").distinct().collect()]
    known = [d for d in dates if d is not None]
    cond = F.col("snapshot_date").isin(known) if known else F.lit(False)
    if len(known) < len(dates):
        cond = cond | F.col("snapshot_date").isNull()
    return stored.where(cond)


def append_metrics(spark: SparkSession, incoming: DataFrame, path: str, domains: DataFrame | None = None,
                   strict_fk: bool = False) -> int:
    """W1 + I1: append only unseen (domain_id, snapshot_date) rows.

    The store is partitioned by snapshot_date, so window filters on it are
    answered by partition pruning, and the anti join only reads the stored
    dates the delivery touches.  Returns the number of rows appended.
    Re-running a load appends nothing twice.

    With ``strict_fk`` a new row whose non-null domain_id is not in
    ``domains`` rejects the whole load (ValueError, nothing written), like
    an enforced foreign key; by default such rows load and the
    referential-integrity check reports them as a WARNING.
    """
    incoming = with_metric_columns(incoming)
    stored = stored_for_dates(read_store(spark, path, schemas.METRICS), incoming)
    # Reliable checkpoint: the append never re-reads the path it is writing to,
    # even if executors (and cached blocks) are lost mid-write.
    counted = Observation()
    fresh = cut_lineage(new_metrics(incoming, stored.select("domain_id", "snapshot_date")).observe(
        counted, F.count(F.lit(1)).alias("rows")))
    if strict_fk:
        if domains is None:
            raise ValueError("strict_fk needs the domains table")
        from domainpulse.operators.quality import orphan_ids

        found = orphan_ids(fresh, domains).agg(F.count(F.lit(1)).alias("ids"), F.sum("rows").alias("rows")).first()
        if found["ids"]:
            raise ValueError(f"foreign key violation: {found['rows']} metric row(s) reference "
                             f"{found['ids']} unknown domain_id(s)")
    n = counted.get["rows"]
    if n:
        fresh.write.mode("append").partitionBy("snapshot_date").parquet(path)
    return n


def append_domains(spark: SparkSession, incoming: DataFrame, path: str, arrival: str = "arrival") -> int:
    """W1 + I2: insert-or-ignore into the domain store."""
    stored = read_store(spark, path, schemas.DOMAINS)
    counted = Observation()
    fresh = cut_lineage(new_domains(incoming, stored, arrival).observe(counted, F.count(F.lit(1)).alias("rows")))
    n = counted.get["rows"]
    if n:
        fresh.write.mode("append").parquet(path)
    return n


def export(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None) -> None:
    """Overwrite an export (parquet by default, CSV with a header on request)."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def append_runs(rows: DataFrame, path: str) -> None:
    """Keep each run's rows: the run's ``run_date`` partition is written, other runs stay."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(path)


def append_audit(spark: SparkSession, issues: DataFrame, path: str, run_ts=None) -> int:
    """Stamp issue rows with run ids after the stored maximum and append."""
    from domainpulse.operators.quality import audit_rows

    stored = read_store(spark, path, schemas.AUDIT_LOG)
    last = stored.agg(F.max("run_id")).first()[0] or 0
    # Materialised once, so the stamped run_ts and ids are the ones written.
    counted = Observation()
    rows = cut_lineage(audit_rows(issues, first_run_id=last + 1, run_ts=run_ts).observe(counted, F.count(F.lit(1)).alias("rows")))
    n = counted.get["rows"]
    if n:
        rows.write.mode("append").parquet(path)
    return n


def audit_event(spark: SparkSession, stage: str, status: str, rows: int, notes: str = "") -> DataFrame:
    """A single stage outcome as an issue row (for ``append_audit``)."""
    return spark.createDataFrame([(0, stage, status, int(rows), notes)], schemas.ISSUE)
