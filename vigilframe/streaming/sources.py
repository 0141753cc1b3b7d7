"""Streams of raw lines and of cleaned events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from vigilframe.functions import events as ev
from vigilframe.plans.silver import accept, enrich
from vigilframe.session import use_utc


def stream_lines(spark: SparkSession, folder: str, max_files: int | None = None, pattern: str = "*.jsonl") -> DataFrame:
    """New matching files of ``folder`` as they appear; the checkpoint remembers the read ones."""
    reader = use_utc(spark).readStream.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(folder).select(
        "value",
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("_file_time"),
    )


def stream_table(
    spark: SparkSession, folder: str, schema: T.StructType, name: str = "*.parquet", max_files: int | None = None
) -> DataFrame:
    """New Parquet files of ``folder`` whose names match ``name``."""
    reader = use_utc(spark).readStream.schema(schema).option("pathGlobFilter", name)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def stream_clean(bronze: DataFrame) -> DataFrame:
    """Valid, enriched events with ``ts``, the event time as a watermarkable timestamp.

    Versions of one event are not resolved here (see ``dedup_stream``).
    """
    return enrich(bronze.filter(accept())).withColumn("ts", F.col("event_time").cast("timestamp"))


def naive(ts: Column) -> Column:
    """Back to a UTC wall-clock timestamp."""
    return ts.cast("timestamp_ntz")


def readable_times(bronze: DataFrame) -> DataFrame:
    """Bronze rows with a readable time, and that time as ``ts``."""
    return bronze.withColumn("ts", ev.parse_time(F.col("event_time")).cast("timestamp")).filter("ts IS NOT NULL")
