"""Incremental ingestion of survey exports with Structured Streaming.

The analysis itself is batch (every source is a finished file); what grows
is the survey: each field season adds export files.  ``ingest_exports``
appends only the files not yet seen to the label-partitioned survey table,
with the same preparation as the batch reader (``degree``, optional family
exclusion, name cleaning, NaN -> NULL).  Progress lives in a checkpoint
folder under ``spark.checkpoint.dir``, so a restarted or failed run resumes
exactly where it stopped; ``availableNow`` processes the backlog and stops.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.names import clean_names
from ..functions.semantics import nan_to_null
from ..session import ensure_checkpoint_dir
from ..sources.survey import prepare_survey_export


def export_stream(spark: SparkSession, path: str, schema: T.StructType,
                  excluded_families: Sequence[str] = (), max_files_per_trigger: int | None = None,
                  has_row_id: bool = True) -> DataFrame:
    """Stream of prepared survey rows from Parquet export files arriving in ``path``.

    The same preparation as the batch reader: its first column, the row id, goes.
    """
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.parquet(path)
    df = prepare_survey_export(df, excluded_families, has_row_id)
    return nan_to_null(df.toDF(*clean_names(df.columns)))


def ingest_exports(spark: SparkSession, source: str, table: str, schema: T.StructType,
                   excluded_families: Sequence[str] = (), checkpoint: str | None = None,
                   partition_by: Sequence[str] = ("label",), has_row_id: bool = True) -> StreamingQuery:
    """Append new export files in ``source`` to the Parquet survey ``table``."""
    tag = hashlib.sha1(table.encode()).hexdigest()[:16]
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/ingest-{tag}"
    return (export_stream(spark, source, schema, excluded_families, has_row_id=has_row_id)
            .writeStream.format("parquet")
            .partitionBy(*partition_by)
            .option("checkpointLocation", ckpt)
            .outputMode("append")
            .trigger(availableNow=True)
            .start(table))
