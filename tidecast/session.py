"""Session helpers: a local session for tests and the shared folder for checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*", partitions: int = 8, app: str = "tidecast", shared: str | None = None
) -> SparkSession:
    """Session for tests and benchmarks; on a cluster the submitter builds the session.

    ``shared`` is the folder for checkpoints and intermediate tables.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.checkpoint.dir", shared or tempfile.mkdtemp(prefix="tidecast-"))
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables, visible to every executor.

    The cluster names it in ``spark.checkpoint.dir``; a session without that setting may have set the
    checkpoint folder of its context. Only a local master, where driver and executors are one machine,
    may run without either: it gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidecast-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point reliable checkpoints at the shared folder unless the context already has one."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
