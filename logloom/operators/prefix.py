"""Running totals over very long groups.

A plain window puts each group into one task; a log file, a run or a user may
hold a third of all rows. Every function here takes a ``chunk`` column that cuts
a group into ordered pieces of bounded size. Totals per chunk are aggregated
first (one small row per chunk), turned into offsets, and added to a window
that only ever spans one chunk. The result equals the plain window.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.session import stage

#: A task that sorts rows gets so many on average, whatever the size of the table.
TASK_ROWS = 250_000

_AGGREGATES = {"sum": F.sum, "max": F.max, "min": F.min, "first": F.min}


def _combine(how: str, carried: Column, local: Column) -> Column:
    if how == "first":
        return carried
    if how == "sum":
        return F.coalesce(carried, F.lit(0)) + F.coalesce(local, F.lit(0))
    return F.greatest(carried, local) if how == "max" else F.least(carried, local)


def dealt(df: DataFrame, rows: int | None, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over as many tasks as ``rows`` rows need, all cores at least; without ``rows`` the planner decides.

    The planner's number of partitions is fixed, so a task's sort would grow with the table.
    """
    if rows is None:
        return df
    return df.repartition(max(ceil(rows / TASK_ROWS), df.sparkSession.sparkContext.defaultParallelism), *keys)


def running(
    df: DataFrame,
    keys: list[str],
    chunk: str,
    order: list[str],
    include_current: bool = False,
    rows: int | None = None,
    **totals: tuple[str, Column],
) -> DataFrame:
    """Add prefix aggregates per group: ``name=("sum" | "max" | "min", column)``.

    ``("first", struct)`` gives every row the smallest struct of its whole group.

    ``chunk`` must not decrease along ``order`` inside a group. Without
    ``include_current`` a row sees only the rows before it. ``rows`` says about how
    many rows there are, so that no task sorts more than its share.
    """
    carried = chunk_totals(df, keys, chunk, **totals)
    within = (
        Window.partitionBy(*keys, chunk)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0 if include_current else -1)
    )
    local = dealt(df, rows, *keys, chunk).withColumns(
        {
            f"__{n}": _AGGREGATES[how](col).over(within) if how != "first" else F.lit(None)
            for n, (how, col) in totals.items()
        }
    )
    joined = local.join(carried, [*keys, chunk], "left")
    result = joined.withColumns(
        {n: _combine(how, F.col(f"__carry_{n}"), F.col(f"__{n}")) for n, (how, _) in totals.items()}
    )
    return result.drop(*[f"__{n}" for n in totals], *[f"__carry_{n}" for n in totals])


def chunk_totals(df: DataFrame, keys: list[str], chunk: str, **totals: tuple[str, Column]) -> DataFrame:
    """Per chunk, the aggregates of all earlier chunks of its group (null for the first)."""
    per_chunk = df.groupBy(*keys, chunk).agg(
        *[_AGGREGATES[how](col).alias(f"__total_{n}") for n, (how, col) in totals.items()]
    )
    if not keys:
        return _whole_table_totals(per_chunk, chunk, totals)
    group = Window.partitionBy(*keys)
    before = group.orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    return per_chunk.select(
        *keys,
        chunk,
        *[
            _AGGREGATES[how](F.col(f"__total_{n}")).over(group if how == "first" else before).alias(f"__carry_{n}")
            for n, (how, _) in totals.items()
        ],
    )


def _whole_table_totals(per_chunk: DataFrame, chunk: str, totals: dict) -> DataFrame:
    """Without keys the chunks themselves are many: they are dealt into ranges, and only ranges meet in one window."""
    ranged = stage(per_chunk.repartitionByRange(chunk).withColumn("__range", F.spark_partition_id()), "chunk-ranges")
    every = Window.partitionBy(F.lit(0))
    earlier = every.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranged.groupBy("__range").agg(
        *[_AGGREGATES[how](F.col(f"__total_{n}")).alias(f"__sum_{n}") for n, (how, _) in totals.items()]
    )
    ranges = ranges.select(
        "__range",
        *[
            _AGGREGATES[how](F.col(f"__sum_{n}")).over(every if how == "first" else earlier).alias(f"__far_{n}")
            for n, (how, _) in totals.items()
        ],
    )
    inside = Window.partitionBy("__range").orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    near = ranged.withColumns(
        {f"__near_{n}": _AGGREGATES[how](F.col(f"__total_{n}")).over(inside) for n, (how, _) in totals.items()}
    )
    return near.join(ranges, "__range").select(
        chunk,
        *[
            # the first row of all has nothing before it
            F.coalesce(_combine(how, F.col(f"__far_{n}"), F.col(f"__near_{n}")), F.col(f"__far_{n}"), F.col(f"__near_{n}")).alias(f"__carry_{n}")
            for n, (how, _) in totals.items()
        ],
    )


def with_position(
    df: DataFrame, keys: list[str], chunk: str, order: list[str], name: str = "position", counted: Column | None = None, rows: int | None = None
) -> DataFrame:
    """Zero-based position in the group; rows where ``counted`` is false use no number."""
    one = F.lit(1) if counted is None else F.when(counted, 1).otherwise(0)
    return running(df, keys, chunk, order, rows=rows, **{name: ("sum", one.cast("bigint"))})


def numbered(df: DataFrame, name: str = "position") -> DataFrame:
    """The rows, written once, with their zero-based place in the order they come in (that of a sort, if ``df`` is sorted).

    A row's place in its task comes with the row, so nothing is sorted again;
    only one total per task is summed up.
    """
    # the low 33 bits of a row's id are its place in the task
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = stage(df.withColumns({"__part": F.spark_partition_id(), "__at": at}), "numbered-rows")
    totals = rows.groupBy("__part").agg(F.count("*").alias("__rows"))
    before = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    return rows.join(offsets, "__part").withColumn(name, F.col("__before") + F.col("__at")).drop("__part", "__at", "__before")
