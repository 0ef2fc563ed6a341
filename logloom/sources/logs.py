"""Log folders to typed entries: format choice, dispatch and the per-format scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions.paths import file_name
from logloom.operators import log_entries as L
from logloom.operators.csv_quotes import join_quoted_lines
from logloom.operators.json_texts import json_layouts, json_values
from logloom.operators.log_reports import FORMATS, union_formats
from logloom.operators.sql_scripts import statements_from_lines
from logloom.session import stage
from logloom.sources import lines as S

COMMON = ["source_file", "source_format", "log_type", "timestamp", "raw_content", "entry_index"]


def read_sql_statements(spark: SparkSession, path: str | list[str], glob: str = S.LOG_GLOB) -> DataFrame:
    """Statements of every script in a folder, through the line table whatever its size."""
    return statements_from_lines(S.read_lines(spark, path, glob, staged=False))


def log_entries(lines: DataFrame, source_format: str = "auto", start=None, end=None, policy: str = "skip") -> dict[str, DataFrame]:
    """Line table of mixed files -> typed entries per format; an explicit format overrides detection."""
    if source_format != "auto" and source_format not in FORMATS:
        raise ValueError(f"unsupported format: {source_format}")
    formats = S.file_formats(lines)
    if source_format != "auto":
        formats = formats.withColumn("source_format", F.lit(source_format))
    formats = json_layouts(lines, formats)
    # one row per file, written once: every format asks it which files it has
    formats = stage(formats, "file-formats")

    def lines_of(condition: str) -> DataFrame:
        wanted = formats.where(condition).select("source_file")
        # the written table tells its size: it is broadcast, or large files are split as skewed partitions
        return lines.join(wanted, "source_file", "left_semi")

    values = {"lines": lines_of("source_format = 'json' and layout = 'lines'")}
    for x in ("array", "object"):
        values[x] = json_values(lines_of(f"source_format = 'json' and layout = '{x}'"), x)
    json = union_formats({x: L.json_entries(v, start, end, policy=policy, rows=v.count()) for x, v in values.items()})
    return {
        "sql": L.sql_entries(statements_from_lines(lines_of("source_format = 'sql'")), start, end),
        "json": json,
        "csv": L.csv_entries(join_quoted_lines(lines_of("source_format = 'csv'")), start, end, policy=policy),
    }


def read_log_entries(
    spark: SparkSession,
    path: str | list[str],
    source_format: str = "auto",
    start: str | None = None,
    end: str | None = None,
    policy: str = "skip",
) -> DataFrame:
    """Entries of a log folder in the common columns."""
    parts = log_entries(S.read_lines(spark, path), source_format, start, end, policy)
    common = {k: df.select(*COMMON) for k, df in parts.items()}
    return union_formats(common).withColumn("source_file", file_name(F.col("source_file")))


def read_log_envelopes(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """Entries of a log folder as envelopes with payload, metadata and processing info."""
    parts = log_entries(S.read_lines(spark, path), **options)
    return union_formats({k: L.to_log_entry(df, k) for k, df in parts.items()})
