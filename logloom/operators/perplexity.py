"""Perplexity from a table of losses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.operators.pairs import long_table


def perplexity_score(losses: DataFrame, weighted: bool = False) -> DataFrame:
    """``loss, n_tokens`` per batch -> perplexity, mean loss, token total.

    The mean is over batches; ``weighted`` weighs a batch by its tokens.
    """
    mean = F.sum(F.col("loss") * F.col("n_tokens")) / F.sum("n_tokens") if weighted else F.avg("loss")
    row = losses.agg(mean.alias("avg_loss"), F.sum("n_tokens").alias("total_tokens")).withColumn(
        "perplexity", F.exp("avg_loss")
    )
    return long_table(row, {k: ("perplexity", k) for k in ("perplexity", "avg_loss", "total_tokens")})
