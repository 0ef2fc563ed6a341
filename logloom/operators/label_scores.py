"""Label precision, recall and F1 from a confusion table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.operators.pairs import long_table


def per_label(pairs: DataFrame) -> DataFrame:
    """``label, support, predicted, hits, precision, recall, f1`` for every true or predicted label.

    Rows are counted once by (reference, prediction); everything after that runs
    on one small row per label pair.
    """
    confusion = pairs.groupBy("reference", "prediction").agg(F.count("*").alias("n"))
    true = confusion.groupBy(F.col("reference").alias("label")).agg(
        F.sum("n").alias("support"), F.sum(F.when(F.col("reference") == F.col("prediction"), F.col("n"))).alias("hits")
    )
    predicted = confusion.groupBy(F.col("prediction").alias("label")).agg(F.sum("n").alias("predicted"))
    both = true.join(predicted, "label", "full_outer").fillna(0, ["support", "hits", "predicted"])

    def ratio(top, bottom):
        return F.when(bottom > 0, top / bottom).otherwise(0.0)

    hits, support, n_pred = F.col("hits"), F.col("support"), F.col("predicted")
    return both.select(
        "label",
        "support",
        "predicted",
        "hits",
        ratio(hits, n_pred).alias("precision"),
        ratio(hits, support).alias("recall"),
        ratio(2 * hits, support + n_pred).alias("f1"),
    )


def label_f1_score(pairs: DataFrame, average: str = "macro", metric: str = "f1") -> DataFrame:
    """``average``: macro, micro or weighted by support."""
    labels, names = per_label(pairs), ("precision", "recall", "f1")
    if average == "macro":
        row = labels.agg(*[F.avg(k).alias(k) for k in names])
    elif average == "weighted":
        row = labels.agg(*[(F.sum(F.col(k) * F.col("support")) / F.sum("support")).alias(k) for k in names])
    elif average == "micro":
        hits = F.sum("hits")
        row = labels.agg(
            (hits / F.sum("predicted")).alias("precision"),
            (hits / F.sum("support")).alias("recall"),
            (2 * hits / (F.sum("predicted") + F.sum("support"))).alias("f1"),
        )
    else:
        raise ValueError(f"unknown average: {average}")
    return long_table(row, {k: (metric, k) for k in names})
