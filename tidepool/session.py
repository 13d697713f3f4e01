"""Session helpers: a local builder for tests and a shared work area."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tidepool", extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a local session with the settings the tests assume.

    On a cluster the session comes from the platform; nothing here is
    required there except what the operators set per call.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TIDEPOOL_DRIVER_MEMORY", "8g"))
    )
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, whose
    executors share the driver's disk, gets a temp folder when nothing is set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidepool-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return sc.getCheckpointDir()


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder.

    Tables, stream checkpoints and snapshots written by the operators live
    here, so every executor and the driver see the same files.
    """
    return f"{_work_base(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def _work_base(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidepool/{spark.sparkContext.applicationId}"


def clear_work(spark: SparkSession) -> None:
    """Remove everything this application wrote under ``work_path``, once its results are used."""
    from tidepool.sources import files

    files.delete(spark, _work_base(spark))
