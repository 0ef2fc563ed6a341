"""Control over where costly columns are evaluated, and the long form of one-row results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def evaluated(df: DataFrame, *names: str) -> DataFrame:
    """The same rows, with the named columns computed at this point and not again.

    Catalyst pushes a filter on a computed column below the projection and
    repeats the expression there; for parsed text that multiplies the work. A
    one-element ``inline`` is a border such filters do not cross.
    """
    others = [c for c in df.columns if c not in names]
    return df.select(*others, F.inline(F.array(F.struct(*names)))).select(*df.columns)


def long_table(row: DataFrame, names: dict[str, tuple[str, str | None]]) -> DataFrame:
    """One-row aggregate -> ``metric, sub_metric, value``; ``names`` maps a column to its two names."""
    items = [
        F.struct(
            F.lit(metric).alias("metric"), F.lit(sub).cast("string").alias("sub_metric"), F.col(c).cast("double").alias("value")
        )
        for c, (metric, sub) in names.items()
    ]
    return row.select(F.inline(F.array(*items)))
