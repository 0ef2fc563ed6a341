"""Unions, filters, groupings and statistics over log entries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.operators.prefix import running
from logloom.session import stage

FORMATS = ("sql", "json", "csv")


def union_formats(parts: dict[str, DataFrame]) -> DataFrame:
    """Entries of several formats or files appended to each other."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts.values())


def regex_filter(entries: DataFrame, pattern: str) -> DataFrame:
    return entries.where(F.col("raw_content").rlike(pattern))


def drop_types(entries: DataFrame, types: list[str]) -> DataFrame:
    """Without the given log types, ignoring case."""
    return entries.where(~F.lower("log_type").isin([x.lower() for x in types]))


def table_groups(entries: DataFrame) -> DataFrame:
    """SQL entries per referenced table and statement type."""
    each = entries.select("source_file", "log_type", F.explode("tables").alias("table_name"))
    # counted per file first, so a hot table is not shuffled row by row
    per_file = each.groupBy("table_name", "log_type", "source_file").agg(F.count("*").alias("n"))
    return per_file.groupBy("table_name", "log_type").agg(F.sum("n").alias("entries"), F.count("*").alias("files"))


def processing_stats(files: DataFrame, entries: DataFrame) -> DataFrame:
    """One row: files seen, files with entries, entries in total and by format, files without entries."""
    per_file = entries.groupBy("source_file").agg(
        F.count("*").alias("n"), F.first("source_format").alias("source_format")
    )
    joined = files.select("source_file").join(per_file, "source_file", "left")
    by_format = F.create_map(
        *[
            x
            for f in FORMATS
            for x in (F.lit(f), F.coalesce(F.sum(F.when(F.col("source_format") == f, F.col("n"))), F.lit(0)))
        ]
    )
    return joined.agg(
        F.count("*").alias("total_files"),
        F.count("n").alias("processed_files"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_entries"),
        by_format.alias("entries_by_format"),
        F.count_if(F.col("n").isNull()).alias("errors"),
    )


def sessions(df: DataFrame, key: str, ts: str, tie: str, gap_seconds: int, chunk: str = "hour") -> DataFrame:
    """Session number per key: a pause longer than ``gap_seconds`` starts the next one.

    Cut by calendar unit so a very busy key spreads over many tasks.
    """
    cut = df.withColumn("__chunk", F.date_trunc(chunk, F.col(ts)))
    previous = running(cut, [key], "__chunk", [ts, tie], __before=("max", F.col(ts)))
    gap = F.unix_micros(ts) - F.unix_micros("__before")
    fresh = F.coalesce((gap > gap_seconds * 1_000_000).cast("bigint"), F.lit(0).cast("bigint"))
    # written once: the second prefix reads these rows twice
    marked = stage(previous.withColumn("__fresh", fresh).drop("__before"), "session-marks")
    numbered = running(
        marked, [key], "__chunk", [ts, tie], include_current=True, session=("sum", F.col("__fresh"))
    )
    return numbered.drop("__chunk", "__fresh")
