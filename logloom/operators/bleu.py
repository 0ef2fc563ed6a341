"""Corpus BLEU with n-gram precisions, scaled to 0..1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.operators.measures import Measure, score
from logloom.operators.ngrams import clipped

ORDER = 4

# The replacements of the 13a tokenizer, in order.
TOKENIZER_13A = [
    ("<skipped>", ""),
    ("-\n", ""),
    ("\n", " "),
    ("&quot;", '"'),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" $1 "),
    (r"([^0-9])([\.,])", r"$1 $2 "),
    (r"([\.,])([^0-9])", r" $1 $2"),
    (r"([0-9])(-)", r"$1 $2 "),
]


def bleu_words(text: Column, tokenizer: str = "13a") -> Column:
    """``13a`` or ``word`` (white space only); case is kept."""
    if tokenizer == "13a":
        text = F.concat(F.lit(" "), text, F.lit(" "))
        for pattern, replacement in TOKENIZER_13A:
            text = F.regexp_replace(text, pattern, replacement)
    elif tokenizer != "word":
        raise ValueError(f"unknown tokenizer: {tokenizer}")
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def bleu_measure(tokenizer: str = "13a", smoothing: str = "exp", references: Column | None = None) -> Measure:
    """``references`` is an array of texts; without it the one ``reference`` counts."""
    orders = range(1, ORDER + 1)
    name = f"bleu_{tokenizer}"
    hyp, refs = f"{name}_hyp", f"{name}_refs"

    def lists(text: Column) -> Column:
        return F.coalesce(bleu_words(text, tokenizer), F.array().cast("array<string>"))

    texts = F.array("reference") if references is None else references
    # the reference length closest to the hypothesis, the shorter one on a tie
    closest = F.array_min(
        F.transform(F.col(refs), lambda r: F.struct(F.abs(F.size(r) - F.size(hyp)).alias("d"), F.size(r).alias("n")))
    )["n"]
    row = {f"{name}_{n}": clipped(F.col(hyp), F.col(refs), n) for n in orders} | {f"{name}_near": closest}

    def total(column: Column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0))

    totals = {f"{name}_m{n}": total(F.col(f"{name}_{n}")["matched"]) for n in orders}
    totals |= {f"{name}_t{n}": total(F.col(f"{name}_{n}")["in_hypothesis"]) for n in orders}
    totals[f"{name}_ref_len"] = total(F.col(f"{name}_near"))
    return Measure(row, totals, _finish(name, smoothing), {hyp: lists(F.col("prediction")), refs: F.transform(texts, lists)})


def _finish(name: str, smoothing: str) -> list[tuple[str, str, Column]]:
    """Score and precisions from the totals; single words are the length of the hypotheses."""
    orders = range(1, ORDER + 1)
    m, t = ({n: F.col(f"{name}_{side}{n}") for n in orders} for side in "mt")
    precision = {}
    for n in orders:
        # orders without a match so far, this one included
        zeros = sum((F.when((m[k] == 0) & (t[k] > 0), 1).otherwise(0) for k in range(1, n + 1)), F.lit(0))
        smoothed = (1.0 / (F.pow(F.lit(2.0), zeros) * t[n])) if smoothing == "exp" else F.lit(0.0)
        precision[n] = F.when(t[n] == 0, 0.0).when(m[n] == 0, smoothed).otherwise(m[n] / t[n])
    near = F.col(f"{name}_ref_len")
    penalty = F.when(t[1] >= near, 1.0).when(t[1] == 0, 0.0).otherwise(F.exp(1 - near / t[1]))
    logs = sum((F.ln(p) for p in precision.values()), F.lit(0.0)) / ORDER
    whole = F.when(F.least(*precision.values()) > 0, penalty * F.exp(logs)).otherwise(0.0)
    return [("bleu", "bleu", whole), *[("bleu", f"precision_{n}", p) for n, p in precision.items()]]


def bleu_score(pairs: DataFrame, tokenizer: str = "13a", smoothing: str = "exp") -> DataFrame:
    """``pairs``: ``prediction`` and ``reference`` (text) or ``references`` (array of texts).

    ``smoothing="exp"`` halves the precision of each order without a match, ``"none"`` leaves it zero.
    """
    references = F.col("references") if "references" in pairs.columns else None
    return score(pairs, [bleu_measure(tokenizer, smoothing, references)])
