"""Helpers shared by the training-data operators: words, uniform numbers, staged tables, running totals, components."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logloom.session import new_path, ship_package, use_utc

#: Words are runs of characters other than these six.
WHITE = " \t\n\u000b\u000c\r"
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ship_package(use_utc(spark)).read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def word_count(column: str) -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def uniform_key(seed: int, *columns: str) -> Column:
    """A 48-bit integer from md5, the same on every run and in every engine. Nulls count as the empty string."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *parts)), 1, 12), 16, 10).cast("long")


def spread(*columns: str) -> Column:
    """A hash for dealing rows into pieces."""
    return F.xxhash64(*columns)


class Staged:
    """Tables written to the shared folder between steps, so that a lost executor costs one step only."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, []

    def write(self, df: DataFrame, codec: str = "lz4") -> DataFrame:
        path = new_path(self.spark, self.label)
        df.write.option("compression", codec).parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop_before(self, keep: int) -> None:
        """Deletes all but the newest ``keep`` tables; for rounds whose input is no longer read."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        while len(self.paths) > keep:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(0))
            path.getFileSystem(conf).delete(path, True)


def running_sum(df: DataFrame, keys: list[str], piece: str, order: list[Column | str], value: str, name: str) -> DataFrame:
    """``name`` = sum of ``value`` over the rows before this one, by (piece, order) within non-null ``keys``.

    A group is cut into pieces, so no task holds a whole group: totals per piece
    are summed first (one row per piece) and added to a window over one piece.
    ``df`` is read twice and should be a staged table.
    """
    by = [*keys, piece]
    totals = df.groupBy(*by).agg(F.sum(value).alias("__total"))
    before = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = before.orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*by, F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = df.join(starts, by)
    return joined.withColumn(name, F.col("__start") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("__start")


def components(edges: DataFrame, stage: Staged, rounds: int = 60) -> DataFrame:
    """Edges (u, v) between longs -> (node, component), component = smallest node reachable.

    Alternates two star operations: every node hangs its larger neighbours, then
    its smaller ones, onto its smallest neighbour, until nothing changes. Each
    round is aggregation and joins over the edges only, written and read back.
    """
    current = stage.write(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = _signature(current)
    for _ in range(rounds):
        if not seen[0]:
            break
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))))
            .where("u != v")
            .distinct()
        )
        current, before = stage.write(small), seen
        seen = _signature(current)
        if seen == before:
            break
        stage.drop_before(2)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = current.groupBy(F.col("v").alias("node")).agg(F.min("v").alias("component"))
    return current.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(roots)


def groups(batches, keys: list[str]):
    """Arrow batches sorted by ``keys`` (none null) -> one batch per group. Groups must be of bounded size."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if held and any(held[-1].column(k)[-1] != batch.column(k)[0] for k in keys):
            yield pa.concat_batches(held)
            held = []
        rows = batch.num_rows
        new = np.zeros(rows - 1, bool)
        for k in keys:
            column = batch.column(k)
            new |= np.asarray(pc.not_equal(column.slice(1), column.slice(0, rows - 1)))
        borders = [0, *(np.flatnonzero(new) + 1).tolist(), rows]
        for a, b in zip(borders[:-1], borders[1:]):
            held.append(batch.slice(a, b - a))
            if b < rows:
                yield pa.concat_batches(held)
                held = []
    if held:
        yield pa.concat_batches(held)


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def first_above(edges: list[float], position: Column) -> Column:
    """Index of the first of the rising ``edges`` above ``position`` (the last index for positions beyond all)."""
    below = reduce(lambda a, b: a + b, [(position >= F.lit(e)).cast("int") for e in edges[:-1]], F.lit(0))
    return below
