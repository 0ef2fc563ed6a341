"""Run-log analyses: users are runs, events are checkpoints, samples and evaluations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.operators import runs as R
from logloom.plans.registry import query
from logloom.plans.rendered import chunk_of


def checkpoints(t) -> DataFrame:
    return t.events.select(
        F.col("user_id").alias("run"),
        F.col("event_id").alias("id"),
        (F.col("event_id") % 50).alias("step"),
        F.col("ts").alias("created_at"),
        F.col("value").alias("eval_loss"),
    )


@query(
    "checkpoint_rotation",
    "SELECT user_id AS run, event_id AS id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 3",
)
def _(t):
    return R.newest(checkpoints(t), 3).select("run", "id")


@query("checkpoint_latest", "SELECT user_id AS run, arg_max(event_id, ts) AS id FROM events GROUP BY user_id")
def _(t):
    return R.latest(checkpoints(t))


@query(
    "checkpoint_latest_after_delete",
    "SELECT user_id AS run, arg_max(event_id, ts) AS id FROM events WHERE event_id NOT IN "
    "(SELECT max(event_id) FROM events GROUP BY user_id) GROUP BY user_id",
)
def _(t):
    deleted = t.events.groupBy("user_id").agg(F.max("event_id").alias("id"))
    return R.latest(checkpoints(t), deleted)


@query("checkpoint_by_step", "SELECT user_id AS run, arg_min(event_id, ts) AS id FROM events WHERE event_id % 50 = 7 GROUP BY user_id")
def _(t):
    return R.find(checkpoints(t), step=7)


@query(
    "checkpoint_best",
    "SELECT user_id AS run, arg_min(event_id, struct_pack(a := value, b := ts)) AS id, min(value) AS value FROM events GROUP BY user_id",
)
def _(t):
    return R.best_checkpoint(checkpoints(t))


@query(
    "early_stop",
    """WITH e AS (SELECT user_id AS run, event_id AS step, value FROM events),
    b AS (SELECT *, min(value) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM e),
    g AS (SELECT *, sum(CASE WHEN best IS NULL OR round(best - value, 9) > 0.05 THEN 1 ELSE 0 END) OVER (PARTITION BY run ORDER BY step) AS grp FROM b),
    s AS (SELECT run, step, row_number() OVER (PARTITION BY run, grp ORDER BY step) - 1 AS streak FROM g)
    SELECT run, min(step) AS stop_step FROM s WHERE streak >= 5 GROUP BY run""",
)
def _(t):
    evaluations = t.events.select(F.col("user_id").alias("run"), F.col("event_id").alias("step"), "value")
    return R.early_stop(evaluations, patience=5, threshold=0.05, chunk=chunk_of(F.col("step")))


@query(
    "running_peak",
    "SELECT event_id, user_id AS run, value, max(value) OVER (PARTITION BY user_id ORDER BY event_id) AS peak FROM events",
)
def _(t):
    samples = t.events.select("event_id", F.col("user_id").alias("run"), "value")
    return R.running_peak(samples, chunk_of(F.col("event_id")), ["event_id"])


@query("every_kth_step", "SELECT event_id, value FROM events WHERE event_id % 10 = 0")
def _(t):
    # the operator itself: logging every tenth step
    return R.every_kth(t.events.select("event_id", "value"), 10, "event_id")


@query(
    "telemetry_summary",
    """SELECT user_id AS run, count(*) AS tracked_steps, max(value) AS peak_value, round(avg(value), 6) AS average_value,
      min(value) AS min_value, max(value) AS max_value, arg_max(value, event_id) AS final_value FROM events GROUP BY user_id""",
)
def _(t):
    samples = t.events.select(F.col("user_id").alias("run"), "event_id", "value")
    return R.telemetry_summary(samples, ["event_id"]).withColumn("average_value", F.round("average_value", 6))


# --- trials: one line item = one trial ---


def trials(t) -> DataFrame:
    return t.lineitem.select(
        F.col("l_suppkey").alias("study"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("trial"),
        F.col("l_quantity").alias("batch_size"),
        F.col("l_discount").alias("dropout"),
        F.col("l_tax").alias("warmup"),
        F.when(F.col("l_returnflag") == "A", F.col("l_extendedprice")).alias("metric"),
        F.when(F.col("l_returnflag") == "N", F.col("l_extendedprice") + 1).alias("eval_loss"),
        (F.col("l_extendedprice") + 2).alias("train_loss"),
    )


_TRIALS = """t AS (SELECT l_suppkey AS study, l_orderkey * 10 + l_linenumber AS trial, l_quantity AS batch_size, l_discount AS dropout, l_tax AS warmup,
  CASE l_returnflag WHEN 'A' THEN l_extendedprice WHEN 'N' THEN l_extendedprice + 1 ELSE l_extendedprice + 2 END AS objective FROM lineitem)"""


@query(
    "best_trial",
    f"""WITH {_TRIALS} SELECT study, trial, batch_size, dropout, warmup, objective FROM t
    QUALIFY row_number() OVER (PARTITION BY study ORDER BY objective, trial, batch_size, dropout, warmup) = 1""",
)
def _(t):
    objective = R.metric_or_loss(F.col("metric"), F.col("eval_loss"), F.col("train_loss"))
    return R.best_trial(trials(t), ["batch_size", "dropout", "warmup"], objective, group=["study"])


@query("metric_fallback", f"WITH {_TRIALS} SELECT study, round(sum(objective), 2) AS total, count(*) AS n FROM t GROUP BY study")
def _(t):
    objective = R.metric_or_loss(F.col("metric"), F.col("eval_loss"), F.col("train_loss"))
    return trials(t).groupBy("study").agg(F.round(F.sum(objective), 2).alias("total"), F.count(objective).alias("n"))


@query(
    "trials_summary",
    """SELECT user_id AS trial, count(*) AS reports, min(value) AS best_value, arg_max(value, event_id) AS last_value,
      max(event_id) AS last_step FROM events GROUP BY user_id""",
)
def _(t):
    return R.trials_summary(t.events.select(F.col("user_id").alias("trial"), F.col("event_id").alias("step"), "value"))


@query(
    "parameter_importance",
    """WITH c AS (SELECT corr(l_quantity, l_extendedprice) AS q, corr(l_discount, l_extendedprice) AS d, corr(l_tax, l_extendedprice) AS x FROM lineitem),
    p AS (SELECT unnest([struct_pack(parameter := 'batch_size', c := q), struct_pack(parameter := 'dropout', c := d), struct_pack(parameter := 'warmup', c := x)]) AS s,
      q * q + d * d + x * x AS total FROM c)
    SELECT s.parameter AS parameter, round(s.c, 6) AS correlation, round(s.c * s.c / total, 6) AS importance FROM p""",
)
def _(t):
    table = R.parameter_importance(trials(t), ["batch_size", "dropout", "warmup"], "train_loss")
    return table.select("parameter", *[F.round(c, 6).alias(c) for c in ("correlation", "importance")])


# --- vectors: labels are keys, the vector number decides the source ---


def vectors(t) -> DataFrame:
    ending = F.when(F.col("label") % 3 == 0, ".weight").when(F.col("label") % 3 == 1, ".bias").otherwise(".scale")
    return t.embeddings.select(
        (F.col("vec_id") % 3).alias("source"), F.concat(F.lit("layer"), F.col("label").cast("string"), ending).alias("key"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )


_VECTORS = """v AS (SELECT vec_id % 3 AS source, label, 'layer' || label || CASE label % 3 WHEN 0 THEN '.weight' WHEN 1 THEN '.bias' ELSE '.scale' END AS key,
  generate_subscripts(embedding, 1) - 1 AS pos, unnest(embedding)::DOUBLE AS value FROM embeddings),
m AS (SELECT key, pos, sum(value * CASE source WHEN 0 THEN 0.5 WHEN 1 THEN 0.25 ELSE 0.25 END) AS value FROM v
  WHERE label % 3 < 2 GROUP BY key, pos)"""


@query("weighted_merge", f"WITH {_VECTORS} SELECT key, pos, round(value, 6) AS value FROM m")
def _(t):
    merged = R.weighted_merge(vectors(t), [0, 1, 2], [0.5, 0.25, 0.25])
    return merged.select("key", F.col("pos").cast("bigint").alias("pos"), F.round("value", 6).alias("value"))


@query(
    "weighted_merge_equal",
    f"""WITH {_VECTORS} SELECT key, count(*) AS dims, round(sum(abs(value)), 6) AS mass FROM
      (SELECT key, pos, sum(value) / 3 AS value FROM v WHERE label % 3 < 2 GROUP BY key, pos) GROUP BY key""",
)
def _(t):
    whole = R.merged_vectors(R.weighted_merge(vectors(t), [0, 1, 2]))
    mass = F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + F.abs(x))
    return whole.select("key", F.size("vector").cast("bigint").alias("dims"), F.round(mass, 6).alias("mass"))


@query(
    "overwrite_known_keys",
    f"""WITH {_VECTORS}, base AS (SELECT key, pos, max(value) AS value FROM v WHERE NOT ends_with(key, '.bias') GROUP BY key, pos)
    SELECT base.key, base.pos, round(coalesce(m.value, base.value), 6) AS value FROM base LEFT JOIN m USING (key, pos)""",
)
def _(t):
    all_vectors = vectors(t)
    # a base without biases: the merged biases are left out, its scales stay as they are
    base = (
        all_vectors.where(~F.endswith("key", F.lit(".bias")))
        .select("key", F.posexplode("vector").alias("pos", "v"))
        .groupBy("key", "pos")
        .agg(F.max("v").alias("value"))
    )
    merged = R.weighted_merge(all_vectors, [0, 1, 2], [0.5, 0.25, 0.25])
    done = R.overwrite_known(base, merged, ["key", "pos"])
    return done.select("key", F.col("pos").cast("bigint").alias("pos"), F.round("value", 6).alias("value"))
