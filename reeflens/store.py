"""Intermediate tables stored as Parquet in the session's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from .session import ensure_checkpoint_dir


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for one table under ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/reeflens/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under ``spark.checkpoint.dir`` and read it back.

    Lineage is cut, columns are pruned on reading, a lost executor reads the
    files again, and the files' byte statistics let Spark choose its joins.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
