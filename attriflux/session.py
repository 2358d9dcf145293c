"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = 8, app: str = "attriflux", **extra: str) -> SparkSession:
    """A local session for tests and the bench. On a cluster use the session that is given."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        # small shuffles of small data still use all local threads
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one machine, may fall
    back to a temporary folder, which is then kept in the session's settings.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="attriflux-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, so that no run overwrites another's table."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def use_checkpoints(spark: SparkSession) -> None:
    """Let Spark keep its checkpoints below the shared folder, unless a place is set already."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_folder(spark)}/checkpoints")
