"""Session configuration and shared-storage helpers.

Library code never creates a session on its own; ``build_session`` is for
tests, benchmarks and command-line use.  On a cluster the session comes from
the platform and already names a shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings an analysis session should have; safe on local mode and clusters.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "credscope", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder.

    A local folder is created only in local mode without a configured one (as
    in tests): on a cluster executors don't share the driver's disk, so there a
    missing ``spark.checkpoint.dir`` raises.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing
    require_local(spark.sparkContext.master)
    local = tempfile.mkdtemp(prefix="credscope-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def require_local(master: str) -> None:
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
