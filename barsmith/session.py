"""Session helpers: one place for the configuration the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job in this library assumes. ANSI mode stays on (Spark 4
# default); divisions go through ``try_divide`` so x/0 is NULL, not an error.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The feature sets' window stages are CPU-bound (hundreds of expressions
    # per row) while their shuffles are narrow bar rows. With the 1 MB default
    # AQE merges a small shuffle into one task and runs every symbol's windows
    # serially; 64 KB keeps small shuffles spread over the cores. Large
    # shuffles are still cut at the advisory partition size.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str = "local[*]", shuffle_partitions: int = 8,
                app_name: str = "barsmith", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster the launcher supplies master, memory and
    ``spark.checkpoint.dir``; this helper is for tests and local runs.
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir`` names, as configured: the same for every driver.

    In a local session that names none, the session's own temporary folder.
    """
    named = (spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
             or spark.conf.get("spark.checkpoint.dir", None))
    return named or ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    The cluster names its shared folder in ``spark.checkpoint.dir``; that value
    always wins. Only a local-mode session with nothing configured (tests, a
    laptop) falls back to a fresh temporary folder: on a cluster a
    machine-local folder is not shared by the executors, so an unset value
    is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder shared by "
                               "all executors (e.g. on the cluster's distributed file system)")
        configured = tempfile.mkdtemp(prefix="barsmith-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables, under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"
