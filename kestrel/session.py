"""Spark session helpers.

Everything in the library is lazy DataFrame code; this module only builds a
session for tests / the bench and resolves shared folders (checkpoints, sink
outputs) from the session configuration.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Configuration we rely on for correctness and scale.  AQE re-plans joins at
# runtime from real shuffle sizes (broadcast conversion, partition coalescing,
# skew-join splitting), which is what keeps un-hinted joins right at 100 TB.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app_name: str = "kestrel", event_log_dir: str | None = None) -> SparkSession:
    """Local session for tests and the bench (clusters bring their own).

    ``event_log_dir`` turns on Spark's event log there (stage and task times
    without the web UI)."""
    master = master or os.environ.get("KESTREL_MASTER", "local[8]")
    builder = SparkSession.builder.master(master).appName(app_name)
    if event_log_dir:
        os.makedirs(event_log_dir, exist_ok=True)
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = (builder
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("KESTREL_DRIVER_MEM", "16g"))
               )
    if master.startswith("local"):  # on a cluster the warehouse is the cluster's
        builder = builder.config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="kestrel-wh-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; create a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/S3/...) folder
    that survives executor loss; tests run without one, so a temp folder is
    set there and only there.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the folder
        try:
            return spark.conf.get("spark.checkpoint.dir")
        except Exception as e:  # noqa: BLE001
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this session") from e
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            conf_dir = None
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="kestrel-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/kestrel-out/{name}-{uuid.uuid4().hex[:12]}"


def use_utc(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
