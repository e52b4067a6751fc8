"""Session helpers: a tuned local session for tests/bench and lineage cuts."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "domainpulse") -> SparkSession:
    """Session for tests and the bench: AQE on, UI off, UTC, Arrow on."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must name shared storage and is only read
    here; if it is missing there, this raises rather than fall back to a
    machine-local folder that executors cannot share.  When it is unset on
    a local master (tests) a scratch folder is created.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage (e.g. an HDFS/S3 path)")
        configured = tempfile.mkdtemp(prefix="domainpulse-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", configured)
        except Exception:  # some deployments reject setting core confs at runtime
            pass
    current = spark.sparkContext.getCheckpointDir() or ""
    if configured.rstrip("/") not in current:  # each call would make one more folder
        spark.sparkContext.setCheckpointDir(configured)
    return configured


#: Folders that the open ``intermediates`` scope deletes when it ends; None outside a scope.
_made: ContextVar[list[str] | None] = ContextVar("intermediates", default=None)


@contextlib.contextmanager
def intermediates(spark: SparkSession) -> Iterator[list[str]]:
    """A scope for the lineage cuts of a run: the folders they write are deleted when it ends.

    Frames made inside are lazy and read those folders, so write or collect
    what should last before the scope ends::

        with intermediates(spark):
            export_outputs(run_chain(domains, metrics), out_dir)

    Scopes nest; each deletes what was made inside it and not in an inner one.
    """
    made: list[str] = []
    token = _made.set(made)
    try:
        yield made
    finally:
        _made.reset(token)
        for path in made:
            folder, files = _in_files(spark, path)
            files.delete(folder, True)


def _in_files(spark: SparkSession, path: str):
    """The path and its file system, as Spark's own readers and writers reach it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    folder, files = _in_files(spark, path)
    return files.exists(folder)


def made_for_run(path: str) -> str:
    """Note a folder of intermediate data for the open scope, if any."""
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder, for tables that a run writes and reads again."""
    return made_for_run(f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Survives executor loss (unlike a local checkpoint) and stops a long
    plan from being recomputed by every downstream action.  Inside an
    ``intermediates`` scope the files go when the scope ends; outside,
    Spark's cleaner removes them once the frame is unreferenced.
    """
    checkpoint_dir(df.sparkSession)
    cut = df.checkpoint(eager=True)
    if _made.get() is not None:
        written = cut._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
        if written.isDefined():
            made_for_run(written.get())
    return cut
