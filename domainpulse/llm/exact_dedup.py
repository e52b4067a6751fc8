"""Exact dedup as a stream over keyed state.

A Structured Streaming query reads the table file by file and keeps, in a
RocksDB state store without expiry, one entry per digest of the normalised
text: the stable identifier and the content locator (file, row) of the row
to keep, and how many rows came.  Rows are pre-aggregated in each task
before they are dealt out by digest, so a text that holds a third of all
rows costs one row per task.  A later run on the same state path goes on
with the files that are new.

The state's digests that were hit again are then read back as a table and
joined to the rows; a row whose digest is not among them stands alone.  A
digest that was hit again proves nothing by itself: the full normalised
bytes of every row of its group are compared with those at the kept row's
locator (hot groups are salted), and should two texts ever share a digest,
its rows are grouped anew by their full bytes.

Texts are equal when identical after all of [\\x20\\x09-\\x0D] is deleted.
The row with the most code points stays, then the smallest doc_id.

Defined results: null text counts as empty, so all empty, blank and null
texts are one group; a null doc_id comes after all others, its group's
keep_id may then be null; repeated rows are separate rows of one group, of
which one stays (ties go by file and row); an empty table gives no rows;
input columns named like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from domainpulse.llm.common import shared_path, small, stored, text_or_empty, without, write

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Session settings while a stream starts: the store, and no disk space set aside in advance for each of many small stores.
STREAM = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: The characters that do not count (fixed values).
BLANKS = " \t\n\v\f\r"
#: Files per micro-batch, and rows that one copy of a kept text is compared with.
FILES_PER_BATCH, ROWS_PER_SALT = 1000, 500
#: Files older than the newest by more than this are skipped by the stream: longer than any history.
FILE_AGE = "365000d"
ADDED = ("keep_id", "group_size", "kept", "text_sha256")


def normalised(text: str = "text") -> Column:
    out = text_or_empty(text)
    for c in BLANKS:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def sha256(norm: Column) -> Column:
    return F.sha2(norm, 256)


def _located(rows: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    return without(rows, *ADDED).select(
        "*", digest(normalised()).alias("_digest"),
        F.struct(
            (-F.char_length(text_or_empty())).alias("l"), F.col("doc_id").isNull().alias("u"), F.col("doc_id").alias("id"),
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
        ).alias("_at"),
    )


def _any_one(path: str) -> str:
    """``path`` as a pattern: the stream's file source takes a single file only by a pattern."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def update_state(spark: SparkSession, path: str, state: str, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Run the stream over what is new under ``path``; the state as (digest, keep, n)."""
    before = {k: spark.conf.get(k, None) for k in STREAM}
    for k, v in STREAM.items():
        spark.conf.set(k, v)
    try:
        rows = spark.readStream.schema(spark.read.parquet(path).schema).option(
            "maxFilesPerTrigger", FILES_PER_BATCH).option("maxFileAge", FILE_AGE).parquet(_any_one(path))
        entries = _located(rows, digest).select("_digest", "_at").groupBy("_digest").agg(
            F.min("_at").alias("keep"), F.count(F.lit(1)).alias("n"))
        query = entries.writeStream.format("noop").outputMode("update").option(
            "checkpointLocation", state).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.format("statestore").load(state).select(
        F.col("key").getField("_digest").alias("_key"), F.col("value").getField("min").alias("_keep"),
        F.col("value").getField("count").alias("_n"))


def _colliding(docs: DataFrame, again: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Digests under which some row's full bytes differ from the kept row's."""
    salts = F.ceil(F.col("_n") / ROWS_PER_SALT).cast("int")
    hit = _located(docs, digest).join(again, F.col("_digest") == F.col("_key")).select(
        "_digest", "_at", "_keep", "_n", normalised().alias("_norm"))
    others = hit.where(F.col("_at") != F.col("_keep")).withColumn(
        "_salt", F.pmod(F.xxhash64("_at"), salts).cast("int"))
    kept = hit.where(F.col("_at") == F.col("_keep")).select(
        F.col("_digest").alias("_d"), F.col("_norm").alias("_kept_norm"),
        F.explode(F.sequence(F.lit(0), salts - 1)).alias("_s"))
    pairs = others.join(kept, (F.col("_digest") == F.col("_d")) & (F.col("_salt") == F.col("_s")))
    return pairs.where(F.col("_norm") != F.col("_kept_norm")).select("_digest").distinct()


def exact_dedup(spark: SparkSession, path: str, state: str | None = None,
                digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Every row of the parquet table at ``path`` with keep_id, group_size, kept and text_sha256.

    ``state``: where the stream keeps its state; a path that an earlier run used goes on from there.
    """
    docs = spark.read.parquet(path)
    if docs.isEmpty():
        return without(docs, *ADDED).select(
            "*", docs["doc_id"].alias("keep_id"), F.lit(0).cast("long").alias("group_size"), F.lit(True).alias("kept"),
            F.lit("").alias("text_sha256"))
    entries = update_state(spark, path, state or shared_path(spark, "dedup-state"), digest)
    again = small(stored(entries.where("_n > 1"), "dedup-hits"))
    alone = F.col("_key").isNull()
    rows = _located(docs, digest).join(again, F.col("_digest") == F.col("_key"), "left").withColumn(
        "_keep", F.when(alone, F.col("_at")).otherwise(F.col("_keep"))).withColumn(
        "_n", F.when(alone, F.lit(1)).otherwise(F.col("_n"))).drop("_key")
    colliding = stored(_colliding(docs, again, digest), "dedup-colliding")
    if not colliding.isEmpty():
        by_bytes = rows.join(colliding, "_digest", "left_semi").withColumn("_norm", normalised())
        groups = by_bytes.groupBy(F.col("_digest").alias("_d"), F.col("_norm").alias("_m")).agg(
            F.min("_at").alias("_keep2"), F.count(F.lit(1)).alias("_n2"))
        apart = by_bytes.join(groups, (F.col("_digest") == F.col("_d")) & (F.col("_norm") == F.col("_m"))).withColumn(
            "_keep", F.col("_keep2")).withColumn("_n", F.col("_n2")).select(*rows.columns)
        rows = rows.join(colliding, "_digest", "left_anti").select(*apart.columns).unionByName(apart)
    return rows.select(
        *[c for c in without(docs, *ADDED).columns],
        F.col("_keep.id").alias("keep_id"), F.col("_n").cast("long").alias("group_size"),
        (F.col("_at") == F.col("_keep")).alias("kept"),
        (F.col("_digest") if digest is sha256 else sha256(normalised())).alias("text_sha256"))


def kept_rows(docs: DataFrame) -> DataFrame:
    """The rows of any frame that stay, with their own columns only.

    The frame is written to the shared folder first, each text once, so that the stream has files to read.
    """
    path = shared_path(docs.sparkSession, "dedup-input")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    # the other columns go as one, so that none clashes with an added one
    rest = F.struct(*[F.col(f"`{c}`") for c in others] or [F.lit(0).alias("none")])
    write(docs.select("doc_id", "text", rest.alias("row")), path)
    kept = exact_dedup(docs.sparkSession, path).where("kept")
    return kept.select(*[F.col(f"row.`{c}`") if c in others else F.col(c) for c in docs.columns])


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, f"{sf_dir}/documents.parquet").select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS l,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
k AS (
  SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY l DESC, doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size,
         row_number() OVER (PARTITION BY norm ORDER BY l DESC, doc_id NULLS LAST) AS r
  FROM d)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, r = 1 AS kept, sha256(norm) AS text_sha256 FROM k
"""
