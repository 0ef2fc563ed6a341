"""Chosen metrics and domain bundles over a pairs table, and model comparison."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.operators.bleu import bleu_measure
from logloom.operators.label_scores import label_f1_score
from logloom.operators.measures import Measure, renamed, score
from logloom.operators.pairs import accuracy_score, match_measure, token_f1_measure
from logloom.operators.perplexity import perplexity_score
from logloom.operators.rouge import rouge_measure

# columns exist only with a session, so measures are made when they are asked for
METRICS: dict[str, Callable[[], Measure]] = {
    "exact_match": lambda: match_measure("exact_match", normalize=True),
    "f1": token_f1_measure,
    "accuracy": lambda: match_measure("accuracy", normalize=True),
    "bleu": bleu_measure,
    "rouge": rouge_measure,
}


def qa_measures() -> list[Measure]:
    return [renamed(METRICS[m](), lambda metric, sub: ("domain", sub or metric)) for m in ("exact_match", "f1")]


def summarization_measures() -> list[Measure]:
    return [
        renamed(rouge_measure(), lambda metric, sub: ("domain", f"{metric}_f1") if sub == "fmeasure" else None),
        renamed(bleu_measure(), lambda metric, sub: ("domain", metric) if sub == "bleu" else None),
    ]


def qa_bundle(pairs: DataFrame) -> DataFrame:
    return score(pairs, qa_measures())


def summarization_bundle(pairs: DataFrame) -> DataFrame:
    return score(pairs, summarization_measures())


def classification_bundle(pairs: DataFrame) -> DataFrame:
    """Accuracy and macro F1; scores per label need a grouping of their own."""
    scores = accuracy_score(pairs).unionByName(label_f1_score(pairs))
    return scores.select(F.lit("domain").alias("metric"), F.coalesce("sub_metric", "metric").alias("sub_metric"), "value")


DOMAINS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "qa": qa_bundle,
    "summarization": summarization_bundle,
    "classification": classification_bundle,
}
# domains made of measures alone join the aggregation of the chosen metrics
DOMAIN_MEASURES: dict[str, Callable[[], list[Measure]]] = {"qa": qa_measures, "summarization": summarization_measures}


def register_domain(name: str, bundle: Callable[[DataFrame], DataFrame]) -> None:
    """Add a domain: a function from pairs to ``metric, sub_metric, value``."""
    DOMAIN_MEASURES.pop(name, None)
    DOMAINS[name] = bundle


def register_measures(name: str, measures: Callable[[], list[Measure]]) -> None:
    """Add a domain made of measures; they are scored together with the chosen metrics."""
    DOMAIN_MEASURES[name] = measures
    DOMAINS[name] = lambda pairs: score(pairs, measures())


def domain_metrics(pairs: DataFrame, domain: str) -> DataFrame:
    """The bundle of a domain; an unknown domain has no metrics."""
    empty = pairs.sparkSession.createDataFrame([], "metric string, sub_metric string, value double")
    return DOMAINS[domain](pairs) if domain in DOMAINS else empty


def calculate_metrics(
    pairs: DataFrame, metrics: list[str], domain: str | None = None, losses: DataFrame | None = None
) -> DataFrame:
    """``metric, sub_metric, value`` of the chosen metrics; names nobody knows are left out.

    All measures over pairs, those of the domain too, share one aggregation;
    losses are another table, and a domain given as a function plans for itself.
    """
    chosen = [METRICS[m]() for m in metrics if m in METRICS]
    fused = domain in DOMAIN_MEASURES
    if fused:
        chosen += DOMAIN_MEASURES[domain]()
    parts = [score(pairs, chosen)] if chosen else []
    if "perplexity" in metrics and losses is not None:
        parts.append(perplexity_score(losses))
    if domain and not fused:
        parts.append(domain_metrics(pairs, domain))
    if not parts:
        raise ValueError(f"no known metric in {metrics}")
    return reduce(DataFrame.unionByName, parts)


def headline(scores: DataFrame) -> DataFrame:
    """Exact match, F1, BLEU and ROUGE-L as one row."""
    chosen = {
        "exact_match": ("exact_match", None),
        "f1": ("f1", "f1"),
        "bleu": ("bleu", "bleu"),
        "rouge_l": ("rougeL", "fmeasure"),
    }
    return scores.agg(
        *[
            F.max(F.when((F.col("metric") == m) & F.col("sub_metric").eqNullSafe(F.lit(s)), F.col("value"))).alias(name)
            for name, (m, s) in chosen.items()
        ]
    )


def common_metrics(scores: DataFrame, models: list[str]) -> DataFrame:
    """Names of the metrics every model has."""
    chosen = scores.where(F.col("model").isin(models))
    counted = chosen.groupBy("metric").agg(F.count_distinct("model").alias("n"))
    return counted.where(F.col("n") == len(models)).select("metric")


def compare_models(scores: DataFrame, models: list[str], metrics: list[str] | None = None) -> DataFrame:
    """``metric, sub_metric`` and one column per model, for metrics present in all of them."""
    shared = scores.join(common_metrics(scores, models), "metric", "left_semi")
    if metrics:
        shared = shared.where(F.col("metric").isin(metrics))
    return shared.groupBy("metric", "sub_metric").pivot("model", models).agg(F.first("value"))
