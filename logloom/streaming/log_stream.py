"""The log normalisation over growing folders of JSON lines.

Stateless columns are those of the batch path; counts use a watermark, so state
is bounded by the lateness allowed and not by the length of the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions.timeparse import time_filter
from logloom.operators.log_entries import json_columns


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("source_file"), F.regexp_replace("value", "\r$", "").alias("line")
    )


def stream_entries(lines: DataFrame, start: str | None = None, end: str | None = None, keep_undated: bool = True) -> DataFrame:
    """Readable lines as typed entries; positions in a file are left to the batch path."""
    typed = json_columns(lines).where("__ok")
    return typed.where(time_filter(F.col("__found.ts"), start, end, keep_undated)).select(
        "source_file",
        F.lit("json").alias("source_format"),
        "log_type",
        F.col("__found.ts").alias("timestamp"),
        "raw_content",
        "field_count",
        "has_nested_objects",
        F.col("__found.field").alias("timestamp_field"),
    )


def without_repeats(entries: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Entries repeated within the watermark are dropped."""
    return entries.withWatermark("timestamp", lateness).dropDuplicatesWithinWatermark(["source_file", "raw_content"])


def windowed_counts(entries: DataFrame, width: str = "1 hour", lateness: str = "1 hour") -> DataFrame:
    """Entries per tumbling window and log type; undated entries belong to no window."""
    dated = entries.where(F.col("timestamp").isNotNull()).withWatermark("timestamp", lateness)
    return dated.groupBy(F.window("timestamp", width).alias("w"), "log_type").agg(F.count("*").alias("entries")).select(
        F.col("w.start").alias("window_start"), "log_type", "entries"
    )


def run_to_end(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process what is there, append it as parquet, and stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_windows_to_end(windows: DataFrame, path: str, checkpoint: str) -> None:
    """Process what is there and write every window that changed, per batch, without waiting for the watermark.

    An append-mode aggregation holds back windows the watermark has not passed, so
    the last ones of a finished stream never come out. Here each batch writes its
    windows as they stand into a folder of its own; a batch that is run again
    replaces that folder. ``last_windows`` reads the result.
    """
    empty = windows.sparkSession.createDataFrame([], windows.schema)
    empty.write.mode("ignore").parquet(f"{path}/batch=-1")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = windows.writeStream.option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()


def last_windows(spark: SparkSession, path: str) -> DataFrame:
    """Every window as its last batch left it; windows of late rows stay as they were when they were dropped."""
    written = spark.read.parquet(path)
    keys = [c for c in written.columns if c not in ("entries", "batch")]
    return written.groupBy(*keys).agg(F.max_by("entries", "batch").alias("entries"))
