"""File scans with explicit schemas (no inference).

CSV columns are bound by the names in the header: any order, extra columns
are dropped, missing ones raise.  Files of one delivery may have different
headers: they are grouped by header and each group is one scan.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from domainpulse import schemas
from domainpulse.config import REQUIRED_DOMAIN_COLUMNS, REQUIRED_METRIC_COLUMNS

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Full scan of one parquet table; Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


#: Text that stands for a missing value (fixed values).
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
    "NaN", "None", "n/a", "nan", "null",
)


def present(name: str) -> Column:
    """A text column with the markers of missing values as null."""
    c = F.col(f"`{name}`")
    return F.when(~F.trim(c).isin(*MISSING), c)


def number(name: str, kind: str) -> Column:
    """A number from text; whole numbers may be written as 3.0, anything unreadable or not finite is null."""
    value = present(name).try_cast("double")
    value = F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)
    if kind != "bigint":
        return value
    return F.coalesce(present(name).try_cast("bigint"), F.when(value == F.floor(value), value.cast("bigint")))


def headers(spark: SparkSession, path: str) -> list[tuple[str, list[str]]]:
    """(header line, files) of a delivery.

    One pass over the lines, which parses nothing and keeps one line per
    file.  What reaches the driver is the list of files, which it holds anyway
    to plan the scan.
    """
    lines = spark.read.text(path).where(F.trim("value") != "").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), "value")
    first = lines.groupBy("file").agg(F.min_by("value", F.struct("block", "row")).alias("header"))
    same = F.regexp_replace("header", "^\ufeff|\r$", "")
    grouped = first.groupBy(same.alias("header")).agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    return sorted(((r["header"], [_literal(f) for f in r["files"]]) for r in grouped), key=lambda g: g[1])


def _literal(file: str) -> str:
    """A file's URL as a path that names just this file."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(file))


def read_headed_csv(spark: SparkSession, path: str, required, what: str, arrival: str | None = None) -> DataFrame:
    """All columns as text under their header names, contract-checked per header; absent extra columns are null.

    ``arrival`` names a column for each row's place in the delivery.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    groups = headers(spark, path)
    if not groups:
        return schemas.require_columns(reader.csv(path), required, what)
    out = None
    for _, files in groups:
        rows = schemas.require_columns(reader.csv(files), required, f"{what} {files[0]}")
        rows = with_arrival(rows, arrival) if arrival else rows
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def read_domains_csv(spark: SparkSession, path: str, arrival: str | None = None) -> DataFrame:
    """Domain dimension from CSV with a header, contract-checked and projected (with ``arrival`` if named)."""
    df = read_headed_csv(spark, path, REQUIRED_DOMAIN_COLUMNS, "domains file", arrival)
    return df.select(*[present(c).alias(c) for c in REQUIRED_DOMAIN_COLUMNS], *([arrival] if arrival else []))


def with_arrival(df: DataFrame, name: str = "arrival") -> DataFrame:
    """A frame of one file scan with each row's place in the delivery: file path, split, row of the split."""
    return df.withColumn(name, F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row")))


def metric_columns(columns: list[str], date_format: str = "yyyy-MM-dd") -> list[Column]:
    """The stored metric columns from delivered text; ``created_at`` may be absent."""
    kinds = {f.name: f.dataType.simpleString() for f in schemas.METRICS.fields}
    created = F.try_to_timestamp(present("created_at")) if "created_at" in columns else F.lit(None).cast("timestamp")
    return [
        present("domain_id").alias("domain_id"),
        F.try_to_date(F.substring(present("snapshot_date"), 1, 10), date_format).alias("snapshot_date"),
        *[number(c, kinds[c]).alias(c) for c in REQUIRED_METRIC_COLUMNS[2:]],
        created.alias("created_at"),
    ]


def read_metrics_csv(spark: SparkSession, path: str, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Metric file from CSV: dates are parsed, unparsable dates become null.

    ``metric_id`` is dropped (ids are assigned on write, if at all) and
    ``created_at`` is parsed to a timestamp.
    """
    raw = read_headed_csv(spark, path, REQUIRED_METRIC_COLUMNS, "metrics file")
    return raw.select(*metric_columns(raw.columns, date_format))
