"""Lines that many documents share (running headers, footers, notices), found and removed.

A line is repeated if at least ``share`` of the documents hold it, and no fewer
than ``least``. Counting every line of a corpus would shuffle a row for nearly
each; instead lines are first counted in ``BUCKETS`` hashed counters, a sketch that
every task builds and any two tasks can add. A repeated line lies in a counter
that reaches the threshold, so only lines in such counters are counted exactly.

There are at most (lines of a document / share) repeated lines, however large
the table is; their hashes become one set that is looked up in the row, and the
texts do not move.

Lines are compared without white space at their ends; blank lines are never
repeated. A document counts once for a line it holds several times. A null text
has no lines and stays null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.session import stage

SHARE = 0.01
LEAST = 3
BUCKETS = 1 << 20
EDGES = " \t\r"


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(EDGES))


def _lines(text: Column) -> Column:
    """The different lines of a text that are not blank."""
    return F.array_distinct(F.filter(F.transform(F.split(text, "\n"), _bare), lambda x: x != ""))


def repeated_lines(df: DataFrame, text: str = "text", share: float = SHARE, least: int = LEAST) -> DataFrame:
    """``line_hash, line, documents``: every repeated line with the number of documents that hold it."""
    threshold = max(least, -(-df.count() * share // 1))
    lines = df.select(F.explode(_lines(F.col(text))).alias("line")).withColumn("line_hash", F.xxhash64("line"))
    counter = F.pmod("line_hash", F.lit(BUCKETS)).alias("counter")
    # one row per counter and task at most is shuffled, whatever the lines are
    full = stage(lines.groupBy(counter).agg(F.count("*").alias("n")).where(F.col("n") >= threshold).select("counter"), "full-counters")
    candidates = lines.join(full, F.pmod("line_hash", F.lit(BUCKETS)) == F.col("counter"), "left_semi")
    counted = candidates.groupBy("line_hash").agg(F.min("line").alias("line"), F.count("*").alias("documents"))
    return stage(counted.where(F.col("documents") >= threshold), "repeated-lines")


def without_lines(df: DataFrame, repeated: DataFrame, text: str = "text", removed: str = "lines_removed") -> DataFrame:
    """``text`` without the lines of ``repeated`` (line_hash), and the number of lines taken out. Other lines stay as they are."""
    hashes = [r[0] for r in repeated.select("line_hash").collect()]
    lines = F.split(F.col(text), "\n")
    kept = F.filter(lines, lambda x: (_bare(x) == "") | ~F.xxhash64(_bare(x)).isin(hashes)) if hashes else lines
    count = F.when(F.col(text).isNull(), 0).otherwise(F.size(lines) - F.size("__kept")).cast("bigint")
    out = df.withColumn("__kept", kept).withColumn(removed, count)
    return out.withColumn(text, F.array_join("__kept", "\n")).drop("__kept")
