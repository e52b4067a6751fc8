"""Incremental ingest of metric files with Structured Streaming.

New files in a landing folder are picked up by a file stream, parsed with
the metric contract, freed of rows whose key was loaded before, and appended
to a date-partitioned parquet sink.  With ``trigger(availableNow=True)`` a
scheduled run processes exactly the files that arrived since the last run,
tracked in the checkpoint.

**First write wins by keyed state.**  The keys loaded so far are state, not a
join with the store: a group of the stateful operator is one domain and one
span of ``SPAN`` days, and its state is one integer with a bit per day.  A
micro-batch looks up the spans it touches and reads no stored row; the state
grows by one integer per domain and span, lives in RocksDB on the executors'
disks with its changes in the checkpoint, and never expires, so a late row of
any age is still told from a repeated one and none is dropped.  As in the
batch load, rows that repeat a key within one micro-batch are all loaded
(``one_per_key`` loads only the first); a group's rows stream through, so a
key of a third of all rows is never held at once.

**Headers.**  Each CSV file is read as one row and parsed by its own header:
columns in any order, extra ones dropped; a file that lacks a column fails the
run with the file's name.  Files are thus held whole in a task; deliveries
beyond some hundred megabytes come as several files.

The stream is declared end to end (no ``foreachBatch``: from PySpark that
would start a callback server for the JVM to call into Python).
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from domainpulse import schemas
from domainpulse.config import REQUIRED_METRIC_COLUMNS
from domainpulse.session import path_exists
from domainpulse.sources.files import metric_columns
from domainpulse.sources.sinks import read_store

#: Days of a state row, one bit each, and the widest file.
SPAN, WIDTH = 64, 128
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: The delivered columns as text, before they are parsed.
DELIVERED = (*REQUIRED_METRIC_COLUMNS, "created_at")
LACKS = "metrics file is missing columns"


def _cells(line: Column) -> Column:
    """The cells of a CSV line; null beyond its last one."""
    parsed = F.from_csv(line, F.lit(", ".join(f"c{i} string" for i in range(WIDTH))))
    # bound to a name, so that a line is parsed once and not once per cell
    return F.transform(F.array(parsed), lambda p: F.array(*[p[f"c{i}"] for i in range(WIDTH)]))[0]


def by_own_header(files: DataFrame) -> DataFrame:
    """The delivered columns, as text, of ``files`` (file, value): one row per file, its content in ``value``.

    What the header says is worked out once per file, before its lines become rows: a row carries its line,
    the places of the delivered columns and what the header lacks, and nothing that grows with the file.
    """
    text = F.when(F.startswith("value", F.lit("\ufeff")), F.expr("substring(value, 2)")).otherwise(F.col("value"))
    lines = F.filter(F.split(text, "\r\n|\n|\r"), lambda line: F.trim(line) != "")
    names = _cells(F.get("lines", F.lit(0)))
    place = lambda c: F.array_position("names", c).cast("int") - 1
    lacking = F.filter(F.array(*[F.lit(c) for c in REQUIRED_METRIC_COLUMNS]), lambda c: F.array_position("names", c) == 0)
    lacks = F.concat(F.lit(f"{LACKS}: "), F.array_join(lacking, ", "), F.lit(" in "), F.col("file"))
    parsed = files.select("file", lines.alias("lines"))
    headed = parsed.select("file", names.alias("names"), F.slice("lines", 2, F.size("lines")).alias("lines"))
    placed = headed.select(
        F.when(F.size(lacking) > 0, lacks).alias("lacks"), F.struct(*[place(c).alias(c) for c in DELIVERED]).alias("place"), "lines")
    rows = placed.select("lacks", "place", F.explode("lines").alias("line"))
    checked = rows.select(
        "place", F.when(F.col("lacks").isNotNull(), F.raise_error(F.col("lacks")).cast("string")).otherwise(F.col("line")).alias("line"))
    cells = checked.select("place", _cells(F.col("line")).alias("cells"))
    return cells.select(*[F.get("cells", F.col("place")[c]).alias(c) for c in DELIVERED])


def delivered_stream(spark: SparkSession, landing: str, fmt: str = "csv") -> DataFrame:
    """Delivered rows of new files, the delivered columns as text."""
    if fmt == "csv":
        files = spark.readStream.format("text").option("wholetext", True).load(landing)
        return by_own_header(files.select(F.col("_metadata.file_path").alias("file"), "value"))
    raw = spark.readStream.schema(schemas.METRICS_FILE).format(fmt).load(landing)
    return raw.select(*[F.col(c).cast("string").alias(c) for c in DELIVERED])


def _first_writes(one_per_key: bool):
    def first_writes(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        loaded = state.get[0] % (1 << SPAN) if state.exists else 0
        now = loaded
        for rows in batches:
            fresh = []
            for day in rows["_day"]:
                bit = 1 << day
                fresh.append(not (now if one_per_key else loaded) & bit)
                now |= bit
            yield rows.loc[fresh, list(DELIVERED)]
        state.update((now - (1 << SPAN) if now >> (SPAN - 1) else now,))  # as a signed 64-bit integer

    return first_writes


def first_write_wins(rows: DataFrame, one_per_key: bool = False) -> DataFrame:
    """The rows of a stream (delivered columns as text) whose (domain, day) no earlier micro-batch held; null matches null."""
    parsed = {c.replace("`", ""): col for c, col in zip(schemas.METRICS.fieldNames(), metric_columns(list(DELIVERED)))}
    day = F.unix_date(parsed["snapshot_date"])
    keyed = rows.select(
        *DELIVERED,
        F.coalesce(F.concat(F.lit("="), parsed["domain_id"]), F.lit("")).alias("_domain"),
        F.coalesce(F.floor(day / SPAN).cast("int"), F.lit(-(1 << 31))).alias("_span"),
        F.coalesce(F.pmod(day, F.lit(SPAN)), F.lit(0)).cast("int").alias("_day"))
    return keyed.groupBy("_domain", "_span").applyInPandasWithState(
        _first_writes(one_per_key), ", ".join(f"{c} string" for c in DELIVERED), "days long", "append", GroupStateTimeout.NoTimeout)


@contextlib.contextmanager
def _rocksdb(spark: SparkSession):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def incremental_ingest(spark: SparkSession, landing: str, store: str, checkpoint: str, fmt: str = "csv",
                       one_per_key: bool = False):
    """Run one availableNow pass: load unseen metric rows from ``landing`` into ``store``.

    The store must be owned by this stream (its sink log lists the files, its
    checkpoint knows the keys).  Raises ValueError if the store holds rows that
    the checkpoint does not know, or if a file lacks a required column.
    Returns the finished StreamingQuery.
    """
    if not path_exists(spark, f"{checkpoint.rstrip('/')}/offsets") and not read_store(spark, store, schemas.METRICS).isEmpty():
        raise ValueError(f"{store} holds rows that the checkpoint {checkpoint} does not know")
    with _rocksdb(spark):
        fresh = first_write_wins(delivered_stream(spark, landing, fmt), one_per_key)
        query = (
            fresh.select(*metric_columns(list(DELIVERED))).writeStream.format("parquet")
            .option("checkpointLocation", checkpoint)
            .partitionBy("snapshot_date")
            .outputMode("append")
            .trigger(availableNow=True)
            .start(store)
        )
        try:
            query.awaitTermination()
        except StreamingQueryException as failure:
            at = str(failure).find(LACKS)
            if at < 0:
                raise
            raise ValueError(str(failure)[at:].splitlines()[0]) from failure
    return query
