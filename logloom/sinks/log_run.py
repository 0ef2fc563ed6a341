"""A log folder normalised in one call: entries written, statistics with times returned."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.operators.log_entries import entry_json, to_log_entry
from logloom.operators.log_reports import FORMATS, processing_stats, union_formats
from logloom.session import discard, stage
from logloom.sinks.writers import write_stats
from logloom.sources import lines as S
from logloom.sources.logs import log_entries


def run_logs(
    spark: SparkSession, path: str | list[str], out: str, source_format: str = "auto", start=None, end=None, policy: str = "skip", now=dt.datetime.now, compression: str = "gzip"
) -> DataFrame:
    """Normalises the files of ``path`` into ``out/entries`` and writes one row of statistics to ``out/stats``.

    The statistics count the files listed, those that gave entries, the entries in
    total and by format, and the files without entries; they carry the start, the
    end and the duration of the run. Files are told apart by their whole path,
    also where the output shows their names only. Every entry is parsed once: it
    is written as its output line, and the counts read two columns of that.

    An output line repeats its entry two or three times, so the lines of a folder
    are several times its size: they are compressed (``"none"`` writes them plain).
    """
    started = now()
    listed = stage(S.all_files(spark, path), "listed-files")
    lines = S.read_lines(spark, path)
    parts = log_entries(lines, source_format, start, end, policy)
    written = {k: entry_json(to_log_entry(df, k, keep=["path"]), keep=["path"]) for k, df in parts.items()}
    entries = stage(union_formats(written), "run-entries", packed=True)
    discard(lines)
    entries.drop("path").write.mode("errorifexists").partitionBy("source_format", "source_file").text(f"{out}/entries", compression=compression)
    stats = processing_stats(listed, entries.select(F.col("path").alias("source_file"), "source_format"))
    # the counts are settled before the clock is read
    counts = stage(stats, "run-stats")
    discard(entries)
    ended = now()
    result = counts.withColumns(
        {
            "start_time": F.lit(started.isoformat()),
            "end_time": F.lit(ended.isoformat()),
            "duration_seconds": F.lit((ended - started).total_seconds()),
        }
    )
    write_stats(result, f"{out}/stats")
    return result


def by_format(stats: DataFrame) -> DataFrame:
    """The statistics with one column per format instead of the map."""
    return stats.select("*", *[F.col("entries_by_format")[f].alias(f"entries_{f}") for f in FORMATS]).drop("entries_by_format")
