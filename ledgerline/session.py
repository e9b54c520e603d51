"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. Timestamps are UTC end to end (the reference's engine has UTC
# TIMESTAMPs); AQE re-plans joins from runtime sizes and splits skewed shuffle partitions.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # the safe-cast rules (e.g. '1.0' is not a BIGINT) rely on ANSI casts, Spark 4's default
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # measured sizes of rows as they are, not of files; the driver holds several times as much while it sends them
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.parquet.filterPushdown": "true",
    # INT96, the default, has no minima and maxima: marks would skip no row group
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # a task that writes one partition value needs no sort; rows of any further value are sorted as before
    "spark.sql.maxConcurrentOutputFileWriters": "1",
}


ESTIMATED, MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SESSION_CONF`` to an existing session, but for what the application was started with.

    Nothing is broadcast by Spark's estimate, which takes 2 KB of a row for each VARIANT column and so holds a narrow look at a
    wide table for a thousandth of what it is. A limit that the application was started with holds for the size measured."""
    given = dict(spark.sparkContext.getConf().getAll())
    for k, v in SESSION_CONF.items():
        if k not in given:
            spark.conf.set(k, v)
    if MEASURED not in given and ESTIMATED in given:
        spark.conf.set(MEASURED, given[ESTIMATED])
    spark.conf.set(ESTIMATED, "-1")
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerline") -> SparkSession:
    """Local session for tests and the bench (UI off, UTC, AQE on)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LEDGERLINE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts, streaming checkpoints and staged tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared file system). Only a local
    session that leaves it unset gets a private temporary folder, which is registered, so later calls
    agree; elsewhere executors would write to disks of their own, so that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint root."""
    import uuid

    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
