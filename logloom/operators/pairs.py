"""Prediction / reference pairs and the scores of single rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.text import normalize_text
from logloom.operators.columns import long_table  # noqa: F401
from logloom.operators.measures import Measure, score


def align(predictions: DataFrame, references: DataFrame, on: str = "example_id", keep_unmatched: bool = True) -> DataFrame:
    """``on, prediction, reference``; predictions without a reference stay (and miss), spare references go."""
    return predictions.join(references, on, "left" if keep_unmatched else "inner").select(on, "prediction", "reference")


def exact_match(prediction: Column, reference: Column, normalize: bool = True) -> Column:
    """1.0 or 0.0 per row; a missing reference is a miss."""
    if normalize:
        prediction, reference = normalize_text(prediction), normalize_text(reference)
    return F.coalesce((prediction == reference).cast("double"), F.lit(0.0))


def _token_set(text: Column, normalize: bool) -> Column:
    words = F.split(normalize_text(text) if normalize else F.lower(text), r"[\s\p{Z}]+")
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def token_scores(prediction: Column, reference: Column, normalize: bool = True) -> Column:
    """``struct<precision, recall, f1>`` over the token sets of one row."""
    sets = F.struct(_token_set(prediction, normalize).alias("p"), _token_set(reference, normalize).alias("r"))

    def score(s: Column) -> Column:
        n_p, n_r = F.size(s["p"]), F.size(s["r"])
        common = F.size(F.array_intersect(s["p"], s["r"]))
        both_empty = (n_p == 0) & (n_r == 0)
        any_empty = (n_p == 0) | (n_r == 0)

        def part(top: Column, bottom: Column) -> Column:
            return F.when(both_empty, 1.0).when(any_empty, 0.0).otherwise(top / bottom)

        # 2pr / (p + r) = 2 common / (n_p + n_r)
        return F.struct(
            part(common, n_p).alias("precision"),
            part(common, n_r).alias("recall"),
            part(2 * common, n_p + n_r).alias("f1"),
        )

    return F.transform(F.array(sets), score)[0]


def example_metrics(pairs: DataFrame, domain: str | None = None) -> DataFrame:
    """Per-example map: exact match on the raw texts, for ``qa`` also F1 on lower-cased words."""
    entries = [F.lit("exact_match"), exact_match(F.col("prediction"), F.col("reference"), normalize=False)]
    if domain == "qa":
        entries += [F.lit("token_f1"), token_scores(F.col("prediction"), F.col("reference"), normalize=False)["f1"]]
    return pairs.withColumn("metrics", F.create_map(*entries))


def match_measure(metric: str, normalize: bool) -> Measure:
    """Mean over all predictions; no rows give null."""
    name = f"match_{'normalized' if normalize else 'raw'}"
    hit = exact_match(F.col("prediction"), F.col("reference"), normalize)
    return Measure({name: hit}, {f"mean_{name}": F.avg(name)}, [(metric, None, F.col(f"mean_{name}"))])


def token_f1_measure(metric: str = "f1") -> Measure:
    """Mean token-set precision, recall and F1 over rows that have a reference."""
    scores = F.when(F.col("reference").isNotNull(), token_scores(F.col("prediction"), F.col("reference")))
    parts = ("precision", "recall", "f1")
    return Measure(
        {"tokens": scores},
        {f"tokens_{p}": F.avg(F.col("tokens")[p]) for p in parts},
        [(metric, p, F.col(f"tokens_{p}")) for p in parts],
    )


def exact_match_score(pairs: DataFrame, normalize: bool = True) -> DataFrame:
    return score(pairs, [match_measure("exact_match", normalize)])


def accuracy_score(pairs: DataFrame, normalize: bool = False) -> DataFrame:
    return score(pairs, [match_measure("accuracy", normalize)])


def token_f1_score(pairs: DataFrame, metric: str = "f1") -> DataFrame:
    return score(pairs, [token_f1_measure(metric)])
