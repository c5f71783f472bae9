"""Session settings and the shared scratch folder.

Results must not depend on session settings the caller may not control, so the
models themselves avoid such dependence (explicit casts, ``nullif`` before
division).  ``build_session`` is for tests, the bench and stand-alone jobs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings the mart relies on when it owns the session.
MART_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    # partition sizing at scale: AQE splits / coalesces shuffles toward ~128 MB,
    # scans read ~256 MB splits, and skewed join partitions are split
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "martlet", extra: dict | None = None) -> SparkSession:
    """A session with the mart's settings.

    Master, shuffle partitions and memory are whatever the job was submitted with;
    they are set only if asked for (tests, the bench).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(MART_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which the driver and all executors share.

    A job without one fails: a folder of our own choosing would be on one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        try:
            named = spark.sparkContext.getCheckpointDir()
        except Exception:  # a session without a local SparkContext
            named = None
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder, for written intermediate tables."""
    return f"{shared_folder(spark)}/martlet-{name}-{uuid.uuid4().hex[:12]}"
