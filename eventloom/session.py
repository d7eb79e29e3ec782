"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the operators rely on, all changeable on a running session.
# forceOptimizeSkewedJoin: the response join is followed by an aggregate on the
# same keys, and without this setting AQE leaves a skewed join alone when
# splitting it would cost one more exchange.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # tables in parts name hundreds of folders; a job for their listing takes longer than the listing
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "512",
    # batches of long texts for Python workers stay small, whatever their number of rows
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 * 1024 * 1024),
    # so do those that are read from files
    "spark.sql.parquet.columnarReaderBatchSize": "1024",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators need to a session made elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "eventloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may go without, as in tests: there the driver and its
    tasks share one machine, so a temporary folder will do.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="eventloom-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/eventloom/{name}-{uuid.uuid4().hex}"


#: Spark's setting to remove the shuffle files of a statement at its end.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Statements begun inside leave no shuffle files; else these stay until the driver collects garbage.

    For steps that are stored, as only what they stored is read from then on.
    """
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before)
