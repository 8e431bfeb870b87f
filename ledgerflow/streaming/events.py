"""Windowed counts over the event stream: the same plan for a batch table and for a live source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of files, with the table's own schema."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def windowed(events: DataFrame, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events and their value by tumbling window and type; late rows are waited for as long as `late` says."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))  # a watermark needs an instant
    rows = rows.withWatermark("ts", late) if events.isStreaming else rows
    grouped = rows.groupBy(F.window("ts", size).alias("w"), "event_type")
    value = F.round(F.sum(F.col("value").cast("decimal(18,6)")), 2).cast("double")  # a decimal sum does not depend on its order
    start = F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start")
    return grouped.agg(F.count("*").alias("n"), value.alias("value")).select(start, "event_type", "n", "value")
