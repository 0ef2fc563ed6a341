"""Tables of a run's samples, checkpoints and trials that a retried run adds to only once.

Every write goes to a folder of its own; a row in the manifest makes it visible.
Readers take one attempt per commit, the earliest one published, so an attempt
that failed before its manifest row, or that ran twice, adds nothing. Nothing is
renamed, so the same holds on stores without an atomic rename.

The run is a column of the files, not a folder: runs grow with the data, and a
folder for each costs a file, a rename and a listing. Rows are sorted by run, so
readers of one run skip the files and row groups that do not hold it.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FILE_BYTES = 128 << 20
MANIFEST = "kind string, commit string, attempt string, n_rows long"


def clustered(rows: DataFrame, keys: list[str], size: Column, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Rows of one key meet in as many tasks as their bytes fill files, at least one; a hot key is spread.

    ``rows`` is read twice (sizes, then rows): hand over a written table. The place
    of a row follows from its content, so a task that runs again deals it the same way.
    """
    files = rows.groupBy(*keys).agg(F.ceil(F.sum(size) / file_bytes).alias("__files"))
    files = files.withColumnsRenamed({k: f"__key_{n}" for n, k in enumerate(keys)})
    match = [F.col(k).eqNullSafe(F.col(f"__key_{n}")) for n, k in enumerate(keys)]
    parts = F.greatest(F.coalesce("__files", F.lit(1)), F.lit(1))
    salted = rows.join(files, match, "left").withColumn("__salt", F.pmod(F.xxhash64(*rows.columns), parts))
    return salted.repartition(*keys, "__salt").select(*rows.columns)


def write_attempt(table: DataFrame, path: str, kind: str, run: str = "run") -> str:
    """Write rows as an attempt no reader sees yet; returns its name. Later attempts have later names."""
    attempt = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    table.sortWithinPartitions(run).write.parquet(f"{path}/{kind}/attempt={attempt}")
    return attempt


def publish(spark: SparkSession, path: str, kind: str, commit: str, attempt: str) -> None:
    """Make an attempt visible, with its number of rows as read back."""
    # rows are counted, no column is read
    written = spark.read.schema("__none int").parquet(f"{path}/{kind}/attempt={attempt}")
    row = written.agg(F.count("*").alias("n_rows")).select(
        F.lit(kind).alias("kind"), F.lit(commit).alias("commit"), F.lit(attempt).alias("attempt"), "n_rows"
    )
    row.write.mode("append").parquet(f"{path}/manifest")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """``kind, commit, attempt, n_rows``: the attempt that counts for every commit."""
    rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    first = Window.partitionBy("kind", "commit").orderBy("attempt")
    return rows.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")


def commit_run(table: DataFrame, path: str, kind: str, commit: str, run: str = "run") -> None:
    """Add a table once under the name ``commit``, however often the run is retried or raced."""
    publish(table.sparkSession, path, kind, commit, write_attempt(table, path, kind, run))


def read_kind(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The committed rows of one kind with their ``commit``; folders of other attempts are pruned, not read."""
    chosen = manifest(spark, path).where(F.col("kind") == kind).select("attempt", "commit")
    return spark.read.parquet(f"{path}/{kind}").join(chosen, "attempt").drop("attempt")
