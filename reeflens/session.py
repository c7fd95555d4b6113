"""SparkSession defaults for the survey pipelines."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "reeflens", extra_conf: dict[str, str] | None = None) -> SparkSession:
    """A session with AQE on (coalescing, skew-join splitting) and the UI off.

    On a cluster pass ``master=None`` and let ``spark-submit`` decide; size
    ``spark.sql.shuffle.partitions`` to the data (AQE coalesces small ones).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra_conf or {}).items():
        b = b.config(k, v)
    if os.environ.get("REEFLENS_DRIVER_MEMORY"):
        b = b.config("spark.driver.memory", os.environ["REEFLENS_DRIVER_MEMORY"])
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names it (a path that driver and executors share).  Only where
    it is unset on a local master, as in a quick trial, is a scratch folder
    made; elsewhere executors could not see such a folder, so that is an error.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or S3)")
        d = tempfile.mkdtemp(prefix="reeflens-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d
