"""Session helpers: a local session for tests/bench and checkpoint-dir handling."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "hearth") -> SparkSession:
    """Session used by tests and bench.py (local mode, UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("HEARTH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster's ``spark.checkpoint.dir`` wins.  Only a local-mode session
    without one (tests, bench) gets a scratch folder of its own; on a cluster
    a machine-local folder would not survive executor loss, so we refuse.
    """
    try:
        sc = spark.sparkContext
    except Exception:          # Spark Connect: only the session conf is visible
        sc = None
    current = sc.getCheckpointDir() if sc is not None and hasattr(sc, "getCheckpointDir") else None
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current and sc is not None:
            sc.setCheckpointDir(current)
    if current:
        return current
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder on the cluster")
    scratch = tempfile.mkdtemp(prefix="hearth-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(scratch)
    else:
        spark.conf.set("spark.checkpoint.dir", scratch)
    return scratch
