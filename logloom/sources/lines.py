"""Log directories as a table of lines or whole texts.

A *line table* has ``source_file, chunk, seq, line``: ``(chunk, seq)`` orders the
lines of a file and a chunk is one file split, so no step needs a whole file.
``source_file`` is the full path here; entries show its last part.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logloom.functions.paths import suffix
from logloom.functions.text import is_blank
from logloom.session import stage

LOG_GLOB = "*.*"


def read_lines(
    spark: SparkSession, path: str | list[str], glob: str = LOG_GLOB, staged: bool = True
) -> DataFrame:
    """Lines of all files, split across tasks. Names without a dot and hidden names are not read.

    Staged by default: positions depend on the file splits, and two reads of the
    same folder may be split differently when executors come and go.
    """
    raw = spark.read.text(path, pathGlobFilter=glob)
    lines = raw.select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("chunk"),
        F.monotonically_increasing_id().alias("seq"),
        F.regexp_replace("value", "\r$", "").alias("line"),
    )
    return stage(lines, "lines", packed=True) if staged else lines


def read_whole(spark: SparkSession, path: str | list[str], glob: str = LOG_GLOB) -> DataFrame:
    """One row per file (``source_file, text``)."""
    raw = spark.read.text(path, wholetext=True, pathGlobFilter=glob)
    return raw.select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("text"))


def list_files(spark: SparkSession, path: str | list[str], glob: str = LOG_GLOB) -> DataFrame:
    """``source_file, size`` of the files a log run looks at; contents are not read."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return raw.select(F.col("path").alias("source_file"), F.col("length").alias("size"))


def all_files(spark: SparkSession, path: str | list[str], glob: str = LOG_GLOB) -> DataFrame:
    """``source_file`` of every file, empty ones too, named as the line table names them.

    Scans leave empty files out. The names are those that Spark's own file index
    holds for any scan of the folder; they are dealt out again as rows.
    """
    names = spark.read.format("text").option("pathGlobFilter", glob).load(path).inputFiles()
    # a scheme without a host is written with one slash in the columns of a scan
    return spark.createDataFrame([(re.sub("^([a-z0-9]+):///", r"\1:/", n),) for n in names], "source_file string")


# File suffixes and content patterns of the three formats.
SQL_SUFFIXES = [".sql"]
JSON_SUFFIXES = [".json", ".jsonl"]
CSV_SUFFIXES = [".csv"]
SQL_CONTENT = r"(?i)(SELECT|INSERT|UPDATE|DELETE|CREATE|ALTER|DROP)\s"


def detect_format(name: Column, head: Column) -> Column:
    """``sql`` / ``json`` / ``csv`` from the file name, else from its first five lines."""
    ext = F.lower(suffix(name))
    sample = F.array_join(F.slice(F.split(head, "\n"), 1, 5), "\n")
    start = F.regexp_extract(sample, r"^[\s\p{Z}]*([{\[])", 1)
    return (
        F.when(ext.isin(SQL_SUFFIXES), "sql")
        .when(ext.isin(JSON_SUFFIXES), "json")
        .when(ext.isin(CSV_SUFFIXES), "csv")
        .when(sample.rlike(SQL_CONTENT), "sql")
        .when((start == "{") & F.contains(sample, F.lit("}")), "json")
        .when((start == "[") & F.contains(sample, F.lit("]")), "json")
        .when(F.contains(F.split(sample, "\n")[0], F.lit(",")), "csv")
        .otherwise("sql")
    )


def file_formats(lines: DataFrame) -> DataFrame:
    """``source_file, source_format`` from the first five lines of every file, ``header`` from its first filled one.

    The first positions of each file come from pruned aggregates; only lines of
    its first chunk, or the one line, are looked at after that. The positions are
    written first: their size is known, so the lines are not moved to meet them.
    """
    first_chunk = stage(lines.groupBy("source_file").agg(F.min("chunk").alias("chunk")), "first-chunks")
    opening = lines.join(first_chunk, ["source_file", "chunk"], "left_semi")
    # the rank limit runs before the shuffle: a task sends five lines per file
    order = Window.partitionBy("source_file").orderBy("seq")
    head = (
        opening.withColumn("__n", F.row_number().over(order))
        .where("__n <= 5")
        .groupBy("source_file")
        .agg(F.sort_array(F.collect_list(F.struct("__n", "line"))).alias("__head"))
        .select("source_file", F.transform("__head", lambda x: x["line"]).alias("__lines"))
    )
    return head.select(
        "source_file",
        detect_format(F.col("source_file"), F.array_join("__lines", "\n")).alias("source_format"),
    ).join(_first_filled(lines), "source_file", "left")


def _first_filled(lines: DataFrame) -> DataFrame:
    """``source_file, header``: the first line of each file that is not blank, however far down."""
    filled = lines.where(~is_blank(F.col("line")))
    chunks = filled.groupBy("source_file", "chunk").agg(F.min("seq").alias("seq"))
    first = chunks.groupBy("source_file").agg(F.min(F.struct("chunk", "seq")).alias("__at"))
    at = stage(first.select("source_file", "__at.chunk", "__at.seq"), "first-filled")
    return lines.join(at, ["source_file", "chunk", "seq"]).select("source_file", F.col("line").alias("header"))
