"""Append-safe loads: only keys not stored yet are appended.

The fact load is a null-safe left anti join of the incoming rows against
the stored keys (no fan-out if the store already holds duplicates); the
dimension load keeps the first arrival per id with ``min_by`` (a partial
aggregate, so one id with many copies is combined map-side).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from domainpulse.config import METRIC_KEY, REQUIRED_DOMAIN_COLUMNS
from domainpulse.operators.ordinal import number_rows


_ZERO = {"string": "", "date": "1970-01-01", "timestamp": "1970-01-01 00:00:00",
         "timestamp_ntz": "1970-01-01 00:00:00"}


def _null_safe_key(df: DataFrame, k: str, prefix: str) -> list[Column]:
    """``k`` as two plain join columns: its value (null -> a zero of its type) and a null flag."""
    dtype = df.schema[k].dataType.simpleString()
    zero = F.lit(_ZERO.get(dtype, 0)).cast(dtype)
    return [F.coalesce(F.col(k), zero).alias(f"{prefix}{k}"), F.col(k).isNull().alias(f"{prefix}{k}_null")]


def null_safe_anti(incoming: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` whose key is not in ``stored`` (NULL matches NULL).

    Stored keys are de-duplicated first (a partial aggregate), so stored
    copies of one key never pile up on one side of the join.  The null-safe
    keys are spelled out as (value, is-null) columns, the pair Spark would
    derive from ``<=>``; de-duplicating on exactly those columns leaves the
    stored keys partitioned as the join needs, so they are shuffled once.
    """
    right = stored.select(*[c for k in keys for c in _null_safe_key(stored, k, "_k_")]).distinct()
    left = incoming.select("*", *[c for k in keys for c in _null_safe_key(incoming, k, "_k_")])
    on = [f"_k_{k}{suffix}" for k in keys for suffix in ("", "_null")]
    return left.join(right, on, "left_anti").drop(*on)


def new_metrics(incoming: DataFrame, stored: DataFrame, keys: Sequence[str] = METRIC_KEY) -> DataFrame:
    """Incoming metric rows whose (domain_id, snapshot_date) is not stored.

    Duplicates inside the incoming batch are kept, as in the source load.
    """
    return null_safe_anti(incoming, stored, keys)


def new_domains(incoming: DataFrame, stored: DataFrame, arrival: str = "arrival") -> DataFrame:
    """Insert-or-ignore.

    Rows with a null name are skipped; the first arrival per non-null id
    wins; ids already stored are skipped; null ids are all accepted.
    """
    cols = list(REQUIRED_DOMAIN_COLUMNS)
    named = incoming.where(F.col("domain_name").isNotNull())
    firsts = (
        named.where(F.col("domain_id").isNotNull())
        .groupBy("domain_id")
        .agg(F.min_by(F.struct(*cols[1:]), F.col(arrival)).alias("_first"))
        .select("domain_id", *[F.col(f"_first.{c}").alias(c) for c in cols[1:]])
    )
    known = stored.select("domain_id").where(F.col("domain_id").isNotNull())
    fresh = firsts.join(known, "domain_id", "left_anti")
    return fresh.unionByName(named.where(F.col("domain_id").isNull()).select(*cols))


def ingest_counts(stored: DataFrame, incoming: DataFrame, inserted: DataFrame) -> DataFrame:
    """Before / incoming / inserted / after as one row (three scalar counts)."""
    before = stored.select(F.count(F.lit(1))).scalar()
    read = incoming.select(F.count(F.lit(1))).scalar()
    added = inserted.select(F.count(F.lit(1))).scalar()
    return stored.sparkSession.range(1).select(
        before.alias("rows_before"), read.alias("rows_incoming"),
        added.alias("rows_inserted"), (before + added).alias("rows_after"),
    )


def assign_metric_ids(df: DataFrame, start: int = 1, order: Sequence[str] = ("snapshot_date", "domain_id"),
                      out: str = "metric_id") -> DataFrame:
    """Dense surrogate ids in key order, continuing after ``start - 1``.

    Numbering is distributed (range partitions + per-partition offsets),
    never one global window.  The order must be unique (the metric key).
    """
    return number_rows(df, list(order), out=out, start=start)
