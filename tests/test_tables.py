import hashlib
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from logloom.operators import dataset as D
from logloom.operators import log_reports as R
from logloom.operators import runs
from logloom.operators.errors import apply_policy, policy_name, rejected
from logloom.operators.prefix import running, with_position


@pytest.mark.parametrize("seed", [1, 2])
def test_running_equals_window(spark, seed):
    rng = random.Random(seed)
    # one group holds most of the rows
    rows = [("hot" if rng.random() < 0.7 else rng.choice("ab"), i, rng.randint(-9, 9)) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, i int, v int").withColumn("c", F.floor(F.col("i") / 7))
    for current in (False, True):
        w = Window.partitionBy("g").orderBy("i").rowsBetween(Window.unboundedPreceding, 0 if current else -1)
        got = running(df, ["g"], "c", ["i"], current, s=("sum", F.col("v")), lo=("min", F.col("v")), hi=("max", F.col("v")))
        want = df.withColumns({"s": F.coalesce(F.sum("v").over(w), F.lit(0)), "lo": F.min("v").over(w), "hi": F.max("v").over(w)})
        cols = ["g", "i", "s", "lo", "hi"]
        assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    first = running(df, ["g"], "c", ["i"], f=("first", F.struct("c", "i", "v"))).groupBy("g").agg(F.min("f.i").alias("a"), F.max("f.i").alias("b"))
    smallest = {r.g: r.m for r in df.groupBy("g").agg(F.min("i").alias("m")).collect()}
    assert {r.g: (r.a, r.b) for r in first.collect()} == {g: (m, m) for g, m in smallest.items()}
    placed = with_position(df, [], "c", ["i"])
    assert all(r.i == r.position for r in placed.collect())


def test_split_is_a_partition(spark):
    df = spark.range(20000)
    split = df.select("id", D.split_name(F.col("id")).alias("split"))
    counts = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
    assert sum(counts.values()) == 20000 and abs(counts["train"] - 16000) < 300 and abs(counts["test"] - 2000) < 200
    again = df.repartition(7).select("id", D.split_name(F.col("id")).alias("split"))
    assert split.exceptAll(again).count() == 0
    assert spark.range(7, 8).select(D.bucket(F.col("id")), D.split_name(F.col("id"))).first()[:] == (407, "train")
    with pytest.raises(ValueError):
        D.split_name(F.col("id"), {"a": 0.5, "b": 0.4})


def test_caps(spark):
    df = spark.range(30000).withColumn("c", F.col("id") - F.col("id") % 1000)
    assert D.first_rows(df, 0, ["id"]).count() == 30000
    assert [r.id for r in D.first_rows(df, 3, ["id"]).collect()] == [0, 1, 2]
    big = D.first_rows(df, 12345, ["id"])
    assert (big.count(), big.agg(F.max("id")).first()[0]) == (12345, 12344)
    by_sort = D.first_rows(df.select("id").repartition(5), 12345, ["id"])
    assert (by_sort.count(), by_sort.agg(F.max("id")).first()[0]) == (12345, 12344)
    assert D.random_rows(df, 12000, "id").distinct().count() == 12000
    assert D.first_rows(df, 30000, ["id"]).count() == D.first_rows(df, 40000, ["id"]).count() == 30000
    assert D.first_rows(df.where("id < 0"), 5, ["id"]).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 11, 400, 999, 1000, 1001])
def test_caps_with_ties_and_nulls(spark, n):
    rows = [(None if i % 5 == 0 else i % 3, "b" if i % 2 else None, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "a int, b string, i int").repartition(7)
    kept = [(r.a, r.b) for r in D.first_rows(df, n, ["a", "b"]).collect()]
    small = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")
    assert sorted(kept, key=small) == sorted([r[:2] for r in rows], key=small)[:n]


def test_shuffle_position(spark):
    rows = D.shuffle_position(spark.range(500).repartition(9), "id").collect()
    ranked = sorted(range(500), key=lambda i: (hashlib.md5(f"{D.SEED}:{i}".encode()).hexdigest(), i))
    assert {r.id: r.position for r in rows} == {i: k for k, i in enumerate(ranked)}


def test_close_shares_give_close_splits(spark):
    names = [D.split_name(F.col("id"), {"a": s, "b": 1 - s}) for s in (0.8, 0.8001)]
    moved = spark.range(50000).where(names[0] != names[1]).count()
    assert 0 < moved < 30


def test_micro_batches(spark):
    rows = D.micro_batches(spark.range(7), 4, 3, "id", F.lit(0)).orderBy("id").collect()
    assert [(r.batch, r.micro_batch) for r in rows] == [(0, 0)] * 3 + [(0, 1)] + [(1, 0)] * 3


def test_prompt(spark):
    df = spark.createDataFrame([("I", None, "O")], "instruction string, input string, output string")
    assert D.with_prompt(df).first().text == "### Instruction:\nI\n\n### Input:\n\n\n### Response:\nO"


def test_validation(spark):
    df = spark.createDataFrame([(1, "a", None), (2, " ", "x")], "id int, t string, u string")
    assert sorted(map(tuple, D.violations(df, "id", ["t", "u"]).collect())) == [(1, "u", "null"), (2, "t", "blank")]
    with pytest.raises(ValueError, match="available: id, t, u"):
        D.require_columns(df, ["id", "zzz"])


def test_duplicates_with_hot_text(spark):
    rows = [(i, "Same text!" if i % 3 == 0 else f"t{i}") for i in range(300)]
    got = D.duplicate_flags(spark.createDataFrame(rows, "id bigint, text string"), "id").collect()
    assert sum(r.is_duplicate for r in got) == 99 and len(got) == 300
    assert {r.copies for r in got if r.id % 3 == 0} == {100} and {r.kept for r in got if r.id % 3 == 0} == {0}


def test_category_join(spark):
    df = spark.range(10).withColumn("k", F.col("id") % 3)
    names = spark.createDataFrame([(0, "a"), (1, "b")], "k bigint, name string")
    got = D.with_category(df, names, "k")
    assert got.count() == 10 and got.where("name is null").count() == 3


def test_errors(spark):
    df = spark.range(4)
    ok = F.col("id") < 3
    assert apply_policy(df, ok).count() == 3 and rejected(df, ok).count() == 1
    assert policy_name("whatever") == "skip"
    with pytest.raises(Exception, match="bad row"):
        apply_policy(df, ok, "fail", F.lit("bad row")).collect()


def test_early_stop(spark):
    values = [1.0, 0.8, 0.79, 0.795, 0.79, 0.5]
    df = spark.createDataFrame([("r", i + 1, v) for i, v in enumerate(values)], "run string, step int, value double")
    for width in (1, 2, 100):
        got = runs.early_stop(df, 3, 0.05, chunk=F.floor(F.col("step") / width)).collect()
        assert [tuple(r) for r in got] == [("r", 5)]
    assert runs.early_stop(df, 9).count() == 0


def test_retention(spark):
    df = spark.createDataFrame([("r", f"c{i}", i, i) for i in (1, 2, 3)], "run string, id string, created_at int, step int")
    assert sorted(r.id for r in runs.newest(df, 2).collect()) == ["c2", "c3"]
    assert runs.latest(df).first().id == "c3"
    assert runs.latest(df, df.where("id = 'c3'")).first().id == "c2"
    assert runs.find(df, step=2).first().id == "c2" and runs.find(df, step=8).count() == 0


def test_weighted_merge(spark):
    df = spark.createDataFrame(
        [("x", "k.weight", [1.0, 2.0]), ("y", "k.weight", [3.0, 6.0]), ("x", "k.other", [9.0]), ("z", "k.weight", [100.0, 1.0])],
        "source string, key string, vector array<double>",
    )
    merged = runs.weighted_merge(df, ["x", "y"], [0.25, 0.75])
    assert [tuple(r) for r in runs.merged_vectors(merged).collect()] == [("k.weight", [2.5, 5.0])]
    first = runs.merged_vectors(runs.weighted_merge(df, ["x", "y"], [1.0, 0.0])).first()
    assert first.vector == [1.0, 2.0]
    for bad in (lambda: runs.check_weights(["x", "y"], [0.5, 0.6]), lambda: runs.check_weights(["x"]), lambda: runs.check_weights(["x", "y"], [1.0])):
        with pytest.raises(ValueError):
            bad()


def test_sessions_cross_days(spark):
    rows = [(1, "2024-01-01 23:59:00"), (2, "2024-01-02 00:01:00"), (3, "2024-01-05 00:00:00")]
    df = spark.createDataFrame([("u", i, t) for i, t in rows], "user string, id int, t string").withColumn("ts", F.col("t").cast("timestamp"))
    got = R.sessions(df, "user", "ts", "id", 3600).orderBy("id").collect()
    assert [r.session for r in got] == [0, 0, 1]


def test_best_trial(spark):
    df = spark.createDataFrame([(1, 0.1, 2.0, None), (2, 0.2, None, 1.0), (3, 0.3, None, None)], "trial int, lr double, metric double, eval_loss double")
    best = runs.best_trial(df, ["lr"], runs.metric_or_loss(F.col("metric"), F.col("eval_loss"), F.lit(5.0))).first()
    assert (best.trial, best.lr, best.objective) == (2, 0.2, 1.0)
    assert runs.best_trial(df, ["lr"], F.coalesce("metric", "eval_loss"), minimize=False).first().trial == 1
