"""n-gram counts of predictions and references, clipped against each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ngrams(words: Column, n: int) -> Column:
    """All n-grams as texts; fewer than ``n`` words give none."""
    if n == 1:
        return words
    count = F.size(words) - n + 1
    return F.when(
        count > 0,
        F.transform(F.sequence(F.lit(1), count), lambda i: F.array_join(F.slice(words, i, F.lit(n)), " ")),
    ).otherwise(F.array().cast("array<string>"))


def repeats(grams: Column) -> Column:
    """The list without the first occurrence of each gram, sorted."""
    return F.transform(F.array(F.sort_array(grams)), lambda s: F.filter(s, lambda g, i: g == F.get(s, i - 1)))[0]


def clipped(hypothesis: Column, references: Column, n: int) -> Column:
    """``struct<matched, in_hypothesis>``: n-grams of one row's word list that its references hold too.

    ``references`` is an array of word lists; a gram counts at most as often as
    in the reference that has it most. Nothing leaves the row, so nothing is
    shuffled and a hot example loads no other task.
    """
    matched = _met(ngrams(hypothesis, n), F.transform(references, lambda r: ngrams(r, n)))
    return F.struct(matched.cast("bigint").alias("matched"), n_grams(hypothesis, n).alias("in_hypothesis"))


def _met(hypothesis: Column, references: Column, sets: int = 2) -> Column:
    """Grams of a list that its references hold too, each clipped.

    First occurrences meet as a set, second ones (one less of every gram on both sides) as the next; the rest is folded.
    """
    if not sets:
        return _folded(hypothesis, references)

    def met(s: Column) -> Column:
        again = _met(repeats(s["hyp"]), F.transform(s["refs"], repeats), sets - 1)
        return F.size(F.array_intersect(s["hyp"], F.flatten(s["refs"]))) + again

    # the one-element array binds both sides once
    return F.transform(F.array(F.struct(hypothesis.alias("hyp"), references.alias("refs"))), met)[0]


def _folded(hypothesis: Column, references: Column) -> Column:
    """The same by one fold.

    All grams are sorted with the side they come from, the hypothesis last, and folded once.
    """
    last = F.lit((1 << 31) - 1)

    def side(grams: Column, number: Column) -> Column:
        return F.transform(grams, lambda g: F.struct(g.alias("gram"), number.alias("side")))

    grams = F.sort_array(F.concat(F.flatten(F.transform(references, side)), side(hypothesis, last)))
    start = F.struct(
        F.lit(None).cast("string").alias("gram"), F.lit(-1).alias("side"),
        F.lit(0).alias("run"), F.lit(0).alias("left"), F.lit(0).alias("matched"),
    )

    def step(done: Column, x: Column) -> Column:
        same = done["gram"].eqNullSafe(x["gram"])
        left = F.when(same, done["left"]).otherwise(0)
        run = F.when(same & (done["side"] == x["side"]), done["run"] + 1).otherwise(1)
        hit = (x["side"] == last) & (left > 0)
        return F.struct(
            x["gram"].alias("gram"), x["side"].alias("side"), run.alias("run"),
            F.when(hit, left - 1).when(x["side"] == last, left).otherwise(F.greatest(left, run)).alias("left"),
            (done["matched"] + F.when(hit, 1).otherwise(0)).alias("matched"),
        )

    return F.aggregate(grams, start, step, lambda done: done["matched"])


def n_grams(words: Column, n: int) -> Column:
    return F.greatest(F.size(words) - (n - 1), F.lit(0)).cast("bigint")
