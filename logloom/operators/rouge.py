"""ROUGE-1, ROUGE-2 and ROUGE-L: precision, recall and F per pair, averaged."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.functions.stemming import stem_words
from logloom.operators.measures import Measure, measured, score
from logloom.operators.ngrams import clipped, n_grams

TYPES = ("rouge1", "rouge2", "rougeL")
PARTS = ("precision", "recall", "fmeasure")


def rouge_words(text: Column, stem: bool = False) -> Column:
    """Lower-cased runs of ``a-z0-9``; with ``stem``, words longer than three letters are stemmed."""
    words = F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")
    return stem_words(words) if stem else words


@F.pandas_udf(T.LongType())
def lcs_length(a: pd.Series, b: pd.Series) -> pd.Series:
    """Length of the longest common subsequence of two word lists, bit-parallel."""

    def one(x, y) -> int:
        where: dict[str, int] = {}
        for i, word in enumerate(x):
            where[word] = where.get(word, 0) | (1 << i)
        full = (1 << len(x)) - 1
        row = full
        for word in y:
            hits = row & where.get(word, 0)
            row = ((row + hits) | (row - hits)) & full
        return len(x) - row.bit_count()

    return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="int64")


def _parts(matched: Column, in_hypothesis: Column, in_reference: Column) -> list[Column]:
    def ratio(top, bottom):
        return F.coalesce(F.when(bottom > 0, top / bottom), F.lit(0.0))

    return [
        ratio(matched, in_hypothesis).alias("precision"),
        ratio(matched, in_reference).alias("recall"),
        ratio(2 * matched, in_hypothesis + in_reference).alias("fmeasure"),
    ]


def rouge_measure(types: tuple[str, ...] = TYPES, stem: bool = True) -> Measure:
    """Plain means over all pairs; a pair without any n-gram of an order counts as zero."""
    kind = "stemmed" if stem else "plain"
    hyp, ref = f"rouge_{kind}_hyp", f"rouge_{kind}_ref"

    def lists(text: str) -> Column:
        return F.coalesce(rouge_words(F.col(text), stem), F.array().cast("array<string>"))

    row, totals, scores = {}, {}, []
    for t in types:
        n = 1 if t == "rougeL" else int(t[5:])
        matched = lcs_length(hyp, ref) if t == "rougeL" else clipped(F.col(hyp), F.array(ref), n)["matched"]
        name = f"{t}_{kind}"
        # the one-element array binds the matches, which all parts use
        row[name] = F.transform(F.array(matched), lambda m: F.struct(*_parts(m, n_grams(F.col(hyp), n), n_grams(F.col(ref), n))))[0]
        for p in PARTS:
            totals[f"{name}_{p}"] = F.avg(F.col(name)[p])
            scores.append((t, p, F.col(f"{name}_{p}")))
    return Measure(row, totals, scores, {hyp: lists("prediction"), ref: lists("reference")})


def rouge_per_example(pairs: DataFrame, types: tuple[str, ...] = TYPES, stem: bool = True) -> DataFrame:
    """``example_id, rouge_type, precision, recall, fmeasure``; no row for an order that neither text has n-grams of."""
    measure = rouge_measure(types, stem)
    kind = "stemmed" if stem else "plain"
    longest = F.greatest(F.size(f"rouge_{kind}_hyp"), F.size(f"rouge_{kind}_ref"))
    sized = Measure({**measure.row, "longest": longest}, {}, [], measure.words)
    each = F.array(*[
        F.struct(F.lit(t).alias("rouge_type"), F.lit(0 if t == "rougeL" else int(t[5:])).alias("least"), F.col(f"{t}_{kind}").alias("parts"))
        for t in types
    ])
    rows = measured(pairs, [sized], ["example_id"]).select("example_id", "longest", F.inline(each))
    return rows.where("longest >= least").select("example_id", "rouge_type", "parts.*")


def rouge_score(pairs: DataFrame, types: tuple[str, ...] = TYPES, stem: bool = True) -> DataFrame:
    return score(pairs, [rouge_measure(types, stem)])
