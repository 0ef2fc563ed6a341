"""Metrics as row measures and mergeable totals, any number of them in one aggregation.

A ``Measure`` says which columns a pair needs (``words``: word lists and the
like, computed once per row however many metrics use them), which numbers it
gives (``row``), how these add up over all pairs (``totals``) and which scores
follow from the totals (``scores``). ``score`` compiles the chosen measures into
one projection and one aggregation: the pairs are read once, every task sends
one row of sums, and nothing else is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.operators.columns import evaluated, long_table


@dataclass(frozen=True)
class Measure:
    """Equal names must mean equal columns, so measures can share them.

    ``scores`` lists ``(metric, sub_metric, column over the totals)``.
    """

    row: dict[str, Column]
    totals: dict[str, Column]
    scores: list[tuple[str, str | None, Column]]
    words: dict[str, Column] = field(default_factory=dict)


def measured(pairs: DataFrame, measures: list[Measure], keep: list[str]) -> DataFrame:
    """``keep`` and the row numbers of all measures."""
    words = {name: c for m in measures for name, c in m.words.items()}
    row = {name: c for m in measures for name, c in m.row.items()}
    if words:
        pairs = evaluated(pairs.withColumns(words), *words)
    # numbers are computed here, not again in every total that uses them
    return evaluated(pairs.withColumns(row).select(*keep, *row), *row)


def score(pairs: DataFrame, measures: list[Measure]) -> DataFrame:
    """``metric, sub_metric, value`` of all measures over ``pairs``."""
    totals = {name: c for m in measures for name, c in m.totals.items()}
    sums = measured(pairs, measures, []).agg(*[c.alias(name) for name, c in totals.items()])
    listed = [s for m in measures for s in m.scores]
    # the one row of sums is bound once, so scores that share a term do not repeat it
    row = evaluated(sums, *totals).select(*[c.alias(f"s{i}") for i, (_, _, c) in enumerate(listed)])
    return long_table(row, {f"s{i}": (metric, sub) for i, (metric, sub, _) in enumerate(listed)})


def renamed(measure: Measure, names) -> Measure:
    """The same measure under other names: ``names(metric, sub_metric)`` gives the new pair, or None to leave a score out."""
    chosen = [(names(metric, sub), c) for metric, sub, c in measure.scores]
    return Measure(measure.row, measure.totals, [(*new, c) for new, c in chosen if new], measure.words)
