"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  Times are stored as UTC days and instants,
# so the session time zone must be UTC.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

DEFAULT_CONF = {
    **REQUIRED_CONF,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# local mode only: the driver is the executor
LOCAL_CONF = {"spark.driver.memory": "8g"}


def get_session(master: str = "local[8]", app: str = "daybook", **conf: str) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the cluster's session."""
    builder = SparkSession.builder.master(master).appName(app)
    extra = LOCAL_CONF if master.startswith("local") else {}
    for k, v in {**DEFAULT_CONF, **extra, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by whoever runs the cluster and is only read here.
    Only in local mode, when it is unset, a scratch folder is created and set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="daybook-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local
