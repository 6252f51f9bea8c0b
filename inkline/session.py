"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app_name: str = "inkline",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    * UTC session time zone: every timestamp in the engine is wall-clock
      (``TIMESTAMP_NTZ``) except the streaming watermark column.
    * AQE with skew-join splitting and partition coalescing: the window
      operators hash on a handful of sources and the dictionary join can meet
      hot n-grams, so runtime re-planning matters.
    * The UI stays off; nothing here opens a port of its own.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.parquet.filterPushdown", "true")
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    That setting must point at storage that all executors share and is only
    read here; without it this fails.  A session on a local master, where
    driver and executors are one process (tests, the bench), gets a folder of
    its own in Python's temporary folder instead, made when an operator first asks for it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("spark.checkpoint.dir is not set; point it at storage that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="inkline-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the checkpoint folder for materialised tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
