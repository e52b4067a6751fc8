"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from domainpulse.session import run_folder

#: Largest number of rows, and of bytes in files, of a small table that may be broadcast; beyond them the join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the folder that ``spark.checkpoint.dir`` names; deleted at the end of an ``intermediates`` scope."""
    return run_folder(spark, name)


#: Rows per Arrow batch where whole texts go to Python, so that a batch of long texts fits in memory.
TEXT_BATCH = 256


@contextlib.contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def text_batches(spark: SparkSession, rows: int = TEXT_BATCH):
    return _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def shuffles_freed(spark: SparkSession):
    """Shuffle files of the queries inside go when each ends, not when the driver happens to collect its garbage."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def write(df: DataFrame, path: str) -> None:
    """``df`` as Parquet files; zstandard, as texts take a third less of the shared folder than by the default."""
    df.write.option("compression", "zstd").parquet(path)


def stored(df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again: a lineage cut that any executor can read.

    ``batch``: rows per Arrow batch of the Python code in ``df``.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    with text_batches(spark, batch) if batch else contextlib.nullcontext(), shuffles_freed(spark):
        write(df, path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a frame that ``stored`` made, once nothing reads them any more."""
    folder = df._jdf.queryExecution().analyzed().relation().location().rootPaths().head()
    folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def bytes_in_files(df: DataFrame) -> int:
    """Bytes of the files that a written table is read from; 0 for any other frame."""
    plan = df._jdf.queryExecution().optimizedPlan()
    return int(str(plan.stats().sizeInBytes())) if plan.nodeName() == "LogicalRelation" else 0


def small(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it is counted to at most ``limit`` rows and its files are small, else as it is."""
    return F.broadcast(df) if is_small(df, rows, limit) else df


def is_small(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> bool:
    if bytes_in_files(df) > BROADCAST_BYTES:
        return False
    return (df.count() if rows is None else rows) <= limit


#: Bits that ``screened`` marks hashes in: 16 MB in 4096 rows, whatever the number of hashes.
SCREEN_BITS = 1 << 27


def screened(rows: DataFrame, hashed: Column, hashes: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two: those whose hash may be among the ``hashes`` (a column of this name), and those whose is not.

    For a join with a table too large to broadcast, where few rows match: only the first part need be shuffled.  A hash
    marks one bit; rows that meet another hash's bit are in the first part too (a share of hashes / ``SCREEN_BITS``).
    """
    place = lambda h: F.pmod(h, F.lit(SCREEN_BITS))
    bucket, bits = (f"_{x}_{uuid.uuid4().hex}" for x in ("bucket", "bits"))  # like no column of the rows
    marks = hashes.select(place(F.col(name)).alias("place")).select(
        F.bitmap_bucket_number("place").alias(bucket), F.bitmap_bit_position("place").alias("bit")).repartition(bucket)
    marks = stored(marks.groupBy(bucket).agg(F.bitmap_construct_agg("bit").alias(bits)), "screen")
    bit = F.bitmap_bit_position(place(hashed))
    byte = F.conv(F.hex(F.substring(bits, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
    marked = rows.join(F.broadcast(marks), F.bitmap_bucket_number(place(hashed)) == F.col(bucket), "left")
    own = [F.col(f"`{c}`") for c in rows.columns]
    return marked.where(hit).select(*own), marked.where(~hit).select(*own)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns of these names (any case), which the caller is about to add."""
    return df.drop(*names)


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


#: Words are runs of anything but these six characters (fixed values).
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    """Number of words of the whole text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def id_text(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The id as text; a row without id goes by a digest of its text."""
    return F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("text:"), F.md5(text_or_empty(text))))


def hex_fraction(digest: Column) -> Column:
    """The first 13 hex digits of a digest as a number in [0, 1)."""
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
