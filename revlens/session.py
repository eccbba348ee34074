"""Session helpers.

Library functions never build their own session; they take the caller's.
``local_session`` is for tests, the bench and the command line: it fills in
settings only where the caller has not set them.
"""

from __future__ import annotations

import os
import tempfile
import warnings

from pyspark.sql import SparkSession

# Defaults applied only when the key is unset.  AQE re-plans joins at
# runtime (broadcast when a side turns out small, skew-split hot keys) and
# coalesces small shuffle partitions, so the static partition count can be
# generous on a cluster.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # PySpark records the Python call site of every Column call for error
    # messages: several extra JVM round trips (~10 ms) per call on the driver.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "revlens") -> SparkSession:
    """A local-mode session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    n = shuffle_partitions or (os.cpu_count() if cores == "*" else int(cores))
    builder = (builder
               .config("spark.sql.shuffle.partitions", str(n))
               .config("spark.driver.memory", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be set by whoever runs the job (a path on
    shared storage).  Only a local-mode session without one gets a fresh
    temporary folder, as in tests.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver context, the setting is all there is
        if configured:
            return configured
        raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
    configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if configured.startswith(("file:", "/")) and not sc.master.startswith("local"):
            warnings.warn("spark.checkpoint.dir is a local path: it must be a mount that every executor shares", stacklevel=2)
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage")
    path = tempfile.mkdtemp(prefix="revlens-ckpt-")
    sc.setCheckpointDir(path)
    return path
