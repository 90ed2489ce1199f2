"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every tidewatch job relies on: UTC wall clock (all stored times are naive UTC),
# adaptive execution for partition coalescing and skew splitting, Arrow for the few
# vectorised UDFs, and no web UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "true",
}


def build_session(master: str | None = None, app: str = "tidewatch",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    On a cluster it must be set to shared storage; leaving it unset is an error.  Only a
    session with a local master falls back to a private scratch folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        current = tempfile.mkdtemp(prefix="tidewatch-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
        spark.sparkContext.setCheckpointDir(current)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current
