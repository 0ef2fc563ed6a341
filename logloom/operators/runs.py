"""Run logs: retention, lookups, early stopping, telemetry, trials, merged vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.operators.prefix import running
from logloom.session import stage

STEPS_PER_CHUNK = 100_000

# --- checkpoint catalogue --------------------------------------------------


def newest(checkpoints: DataFrame, keep: int, run: str = "run") -> DataFrame:
    """The ``keep`` latest checkpoints of each run.

    Spark limits the rank inside every task before the shuffle, so a long run
    sends at most ``keep`` rows per task.
    """
    latest_first = Window.partitionBy(run).orderBy(F.col("created_at").desc(), F.col("id").desc())
    return checkpoints.withColumn("__n", F.row_number().over(latest_first)).where(F.col("__n") <= keep).drop("__n")


def latest(checkpoints: DataFrame, deleted: DataFrame | None = None, run: str = "run") -> DataFrame:
    """``run, id`` of the latest checkpoint that was not deleted."""
    alive = checkpoints if deleted is None else checkpoints.join(deleted.select("id"), "id", "left_anti")
    return alive.groupBy(run).agg(F.max_by("id", F.struct("created_at", "id")).alias("id"))


def find(checkpoints: DataFrame, run: str = "run", **where) -> DataFrame:
    """First checkpoint of each run with the given step or epoch, in order of creation."""
    found = checkpoints
    for name, value in where.items():
        found = found.where(F.col(name) == value)
    return found.groupBy(run).agg(F.min_by("id", F.struct("created_at", "id")).alias("id"))


def best_checkpoint(checkpoints: DataFrame, metric: str = "eval_loss", greater_is_better: bool = False, run: str = "run") -> DataFrame:
    """``run, id, value`` of the best checkpoint; the earlier one on a tie."""
    value = F.col(metric) if not greater_is_better else -F.col(metric)
    ranked = checkpoints.where(F.col(metric).isNotNull()).groupBy(run).agg(
        F.min(F.struct(value.alias("v"), F.col("created_at"), F.col("id"), F.col(metric).alias("value"))).alias("b")
    )
    return ranked.select(run, F.col("b.id").alias("id"), F.col("b.value").alias("value"))


# --- early stopping --------------------------------------------------------


def early_stop(
    evaluations: DataFrame, patience: int, threshold: float = 0.0, chunk: Column | None = None, run: str = "run", digits: int = 9
) -> DataFrame:
    """``run, stop_step``: first step after ``patience`` evaluations without a real improvement.

    An evaluation improves if it is the first or beats the best before it by more
    than ``threshold``. ``evaluations`` has ``step`` and ``value`` (lower is better).
    """
    steps = F.col("step") - F.col("step") % STEPS_PER_CHUNK
    cut = evaluations.select(run, "step", "value", (chunk if chunk is not None else steps).alias("__chunk"))
    best = running(
        cut, [run], "__chunk", ["step"],
        __best=("min", F.col("value")), __index=("sum", F.lit(1).cast("bigint")),
    )
    gain = F.round(F.col("__best") - F.col("value"), digits)
    improved = F.col("__best").isNull() | (gain > threshold)
    # written once: the second prefix reads these rows twice
    marked = stage(best.select(run, "step", "__chunk", "__index", F.when(improved, F.col("__index")).alias("__at")), "evaluations")
    since = running(marked, [run], "__chunk", ["step"], include_current=True, __last=("max", F.col("__at")))
    streak = F.col("__index") - F.col("__last")
    return since.where(streak >= patience).groupBy(run).agg(F.min("step").alias("stop_step"))


# --- telemetry -------------------------------------------------------------


def running_peak(samples: DataFrame, chunk: Column, order: list[str], value: str = "value", run: str = "run") -> DataFrame:
    """Adds ``peak``: the largest value so far in the run."""
    cut = samples.withColumn("__chunk", chunk)
    return running(cut, [run], "__chunk", order, include_current=True, peak=("max", F.col(value))).drop("__chunk")


def every_kth(samples: DataFrame, k: int, step: str = "step") -> DataFrame:
    return samples.where(F.col(step) % k == 0)


def telemetry_summary(samples: DataFrame, order: list[str], value: str = "value", peak: str = "value", run: str = "run") -> DataFrame:
    """Samples, peak, mean, smallest, largest and last value per run."""
    return samples.groupBy(run).agg(
        F.count("*").alias("tracked_steps"),
        F.max(peak).alias("peak_value"),
        F.avg(value).alias("average_value"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.max_by(value, F.struct(*order)).alias("final_value"),
    )


# --- trials ----------------------------------------------------------------


def metric_or_loss(metric: Column, eval_loss: Column, train_loss: Column) -> Column:
    """The chosen metric, else the evaluation loss, else the training loss."""
    return F.coalesce(metric, eval_loss, train_loss)


def best_trial(trials: DataFrame, params: list[str], objective: Column, minimize: bool = True, group: list[str] | None = None) -> DataFrame:
    """Trial number, parameters and objective of the best trial; the lower number on a tie."""
    scored = trials.select(*(group or []), "trial", *params, objective.alias("objective")).where("objective is not null")
    sign = F.col("objective") if minimize else -F.col("objective")
    best = scored.groupBy(*(group or [])).agg(
        F.min(F.struct(sign.alias("v"), F.col("trial"), *[F.col(p) for p in params], F.col("objective"))).alias("b")
    )
    return best.select(*(group or []), "b.trial", *[f"b.{p}" for p in params], "b.objective")


def trials_summary(reports: DataFrame) -> DataFrame:
    """One row per trial from its reports (``trial, step, value``): number, best and last value."""
    return reports.groupBy("trial").agg(
        F.count("*").alias("reports"),
        F.min("value").alias("best_value"),
        F.max_by("value", "step").alias("last_value"),
        F.max("step").alias("last_step"),
    )


def parameter_importance(trials: DataFrame, params: list[str], metric: str) -> DataFrame:
    """``parameter, correlation, importance``: correlation with the metric and its share of the squared sum."""
    row = trials.agg(*[F.corr(p, metric).alias(p) for p in params])
    squares = sum((F.coalesce(F.col(p) * F.col(p), F.lit(0.0)) for p in params), F.lit(0.0))
    items = F.array(
        *[
            F.struct(
                F.lit(p).alias("parameter"), F.col(p).alias("correlation"), (F.col(p) * F.col(p) / squares).alias("importance")
            )
            for p in params
        ]
    )
    return row.select(F.inline(items))


# --- keyed vectors ---------------------------------------------------------

# The key endings that are merged.
MERGED_KEYS = (".weight", ".bias")


def check_weights(sources: list, weights: list[float] | None = None) -> list[float]:
    """Equal weights by default; given ones must fit the sources and sum to 1."""
    if len(sources) < 2:
        raise ValueError("at least two sources are needed")
    if weights is None:
        return [1.0 / len(sources)] * len(sources)
    if len(weights) != len(sources):
        raise ValueError("one weight per source is needed")
    if abs(sum(weights) - 1.0) > 1e-6:
        raise ValueError("weights must sum to 1")
    return weights


def weighted_merge(vectors: DataFrame, sources: list, weights: list[float] | None = None) -> DataFrame:
    """``source, key, vector`` -> ``key, pos, value``: weighted sums over the given sources.

    Sums are partial per task before the shuffle. The weights are literals in the
    plan, one per named source.
    """
    weights = check_weights(sources, weights)
    weight = None
    for source, w in zip(sources, weights):
        condition = F.col("source") == source
        weight = F.when(condition, F.lit(float(w))) if weight is None else weight.when(condition, F.lit(float(w)))
    ending = F.lit(False)
    for suffix in MERGED_KEYS:
        ending = ending | F.endswith("key", F.lit(suffix))
    used = vectors.where(F.col("source").isin(sources) & ending).select(
        "key", weight.alias("w"), F.posexplode("vector").alias("pos", "v")
    )
    return used.groupBy("key", "pos").agg(F.sum(F.col("w") * F.col("v")).alias("value"))


def merged_vectors(merged: DataFrame) -> DataFrame:
    """``key, vector`` with the positions in order."""
    return merged.groupBy("key").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "value"))), lambda x: x["value"]).alias("vector")
    )


def overwrite_known(base: DataFrame, merged: DataFrame, on: list[str]) -> DataFrame:
    """Base rows with merged values where there are any; keys the base lacks are left out."""
    new = merged.select(*on, F.col("value").alias("__new"))
    return base.join(new, on, "left").withColumn("value", F.coalesce("__new", "value")).drop("__new")
