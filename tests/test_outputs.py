import datetime as dt
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from logloom.operators import evaluation
from logloom.operators import log_entries as L
from logloom.operators.log_reports import processing_stats
from logloom.session import stage
from logloom.sinks import catalogue
from logloom.sinks import writers as K
from logloom.sinks.images import read_images, write_images
from logloom.sources import datasets as S
from logloom.streaming import log_stream
from tests.test_logs import lines_of
from tests.test_metrics import make


def test_entry_sink_keeps_equal_stems_apart(spark, tmp_path):
    path = str(tmp_path / "out")
    lines = lines_of(spark, {"a.json": '{"type":"x","k":"ü"}', "b.json": '{"type":"y"}'})
    K.write_entries(L.to_log_entry(L.json_entries(lines), "json"), path)
    assert sorted(os.listdir(path + "/source_format=json")) == ["source_file=a.json", "source_file=b.json"]
    first = spark.read.text(path).where("source_file = 'a.json'").first().value
    assert json.loads(first)["processed_content"] == {"type": "x", "k": "ü"}


def test_stats_sink(spark, tmp_path):
    files = spark.createDataFrame([("a",), ("b",)], "source_file string")
    entries = spark.createDataFrame([("a", "sql"), ("a", "sql")], "source_file string, source_format string")
    K.write_stats(processing_stats(files, entries), str(tmp_path / "s"))
    row = spark.read.json(str(tmp_path / "s")).first()
    assert (row.total_files, row.processed_files, row.total_entries, row.errors) == (2, 1, 2, 1)
    assert row.entries_by_format.asDict() == {"csv": 0, "json": 0, "sql": 2}


@pytest.mark.parametrize("fmt", ["jsonl", "csv", "parquet"])
def test_dataset_round_trip(spark, tmp_path, fmt):
    path = str(tmp_path / f"d.{fmt}")
    rows = spark.createDataFrame([('say "a,\nb"', "train"), ("x", "val")], "text string, split string").withColumn("metadata", F.struct(F.lit("f").alias("file")))
    K.write_dataset(rows, path, fmt)
    back = S.load_dataset(spark, path, ["text", "split"])
    assert sorted((r.text, r.split) for r in back.collect()) == [('say "a,\nb"', "train"), ("x", "val")]
    with pytest.raises(ValueError, match="missing columns"):
        S.load_dataset(spark, path, ["prompt"])


def test_load_by_extension(spark, tmp_path):
    plain = tmp_path / "rows.dat"
    plain.write_text('{"prompt":"p","response":"r"}\n')
    assert S.load_dataset(spark, str(plain), ["prompt", "response"]).count() == 1
    both = S.load_train_and_validation(spark, str(plain))
    assert sorted(r.split for r in both.collect()) == ["train", "validation"]
    with pytest.raises(ValueError):
        K.write_dataset(both, str(tmp_path / "x"), "xml")


def test_missing_to_null(spark):
    df = spark.createDataFrame([(float("nan"), "NA", 1), (2.0, "b", 2)], "a double, b string, c int")
    assert sorted(map(tuple, S.missing_to_null(df).collect()), key=str) == [(2.0, "b", 2), (None, None, 1)]


def test_scores_and_report(spark, tmp_path):
    df = make(spark, [("the cat", "the cat"), ("a", "b")])
    scores = evaluation.calculate_metrics(df, ["exact_match", "f1", "bleu", "rouge", "accuracy"], domain="qa")
    path = str(tmp_path)
    K.write_scores(scores, f"{path}/scores")
    assert {x.split("=")[1] for x in os.listdir(f"{path}/scores") if "=" in x} >= {"bleu", "rougeL", "f1", "exact_match"}
    now = dt.datetime(2024, 1, 2, 3, 4, 5)
    folder = K.write_report(scores, path, "models/mine/", df.withColumn("prompt", F.lit("q")).limit(1), now)
    assert folder.endswith("mine_20240102_030405")
    text = "\n".join(r.value for r in spark.read.text(f"{folder}/evaluation_report").collect())
    for part in ("# Model Evaluation Report", "| rouge1 | 0.5000 | 0.5000 | 0.5000 |", "- **Score:** 0.5000", "### Example 1", "### Domain-Specific Metrics"):
        assert part in text
    assert spark.read.json(f"{folder}/evaluation_results").count() == scores.count()


def test_run_catalogue_appends(spark, tmp_path):
    path = str(tmp_path / "runs")
    for run in ("a", "b"):
        K.append_run(spark.createDataFrame([(run, 1, 2.0)], "run string, step int, value double"), path)
    assert spark.read.parquet(path).groupBy("run").count().count() == 2


def test_stream_equals_batch(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    rows = [{"type": "ab"[i % 2], "time": f"2024-01-01T{i // 60:02d}:{i % 60:02d}:00"} for i in range(300)]
    for part in range(3):
        (source / f"p{part}.jsonl").write_text("\n".join(json.dumps(r) for r in rows[part * 100 : part * 100 + 100]) + "\n{bad\n")
    entries = log_stream.stream_entries(log_stream.stream_lines(spark, str(source), max_files=1), start="2024-01-01", end="2024-01-02")
    log_stream.run_to_end(entries, out, str(tmp_path / "state"))
    columns = ["log_type", "timestamp", "field_count", "timestamp_field", "raw_content"]
    lines = spark.read.text(str(source)).select(F.lit("x").alias("source_file"), F.lit(0).cast("bigint").alias("chunk"), F.monotonically_increasing_id().alias("seq"), F.col("value").alias("line"))
    batch = L.json_entries(lines).select(columns)
    stream = spark.read.parquet(out).select(columns)
    assert stream.count() == 300 and stream.exceptAll(batch).count() == 0


def test_stream_drops_repeats_and_closes_windows(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    rows = [{"type": "a", "time": f"2024-01-01T{h:02d}:30:00"} for h in (1, 2, 9)]
    (source / "p.jsonl").write_text("\n".join(json.dumps(r) for r in rows + rows) + "\n")
    entries = log_stream.stream_entries(log_stream.stream_lines(spark, str(source)))
    log_stream.run_to_end(log_stream.without_repeats(entries), str(tmp_path / "u"), str(tmp_path / "us"))
    assert spark.read.parquet(str(tmp_path / "u")).count() == 3
    log_stream.run_to_end(log_stream.windowed_counts(entries), str(tmp_path / "w"), str(tmp_path / "ws"))
    got = sorted((str(r.window_start), r.entries) for r in spark.read.parquet(str(tmp_path / "w")).collect())
    # the window at nine is still open
    assert got == [("2024-01-01 01:00:00", 2), ("2024-01-01 02:00:00", 2)]


def test_last_windows_need_no_later_line(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    out, state = str(tmp_path / "w"), str(tmp_path / "ws")
    counts = log_stream.windowed_counts(log_stream.stream_entries(log_stream.stream_lines(spark, str(source), max_files=1)), lateness="3 hours")
    log_stream.run_windows_to_end(counts, out, state)
    assert log_stream.last_windows(spark, out).count() == 0
    want = {}
    for part, hours in enumerate([(1, 1, 2), (2, 3), (3, 1), (0, 9)]):
        (source / f"p{part}.jsonl").write_text("\n".join(json.dumps({"type": "a", "time": f"2024-01-01T{h:02d}:30:00"}) for h in hours) + "\n")
        log_stream.run_windows_to_end(counts, out, state)
        for h in hours:
            want[h] = want.get(h, 0) + 1
        got = {r.window_start.hour: r.entries for r in log_stream.last_windows(spark, out).collect()}
        assert got == want
    assert len(list(source.iterdir())) == 4


def test_serializable(spark):
    df = spark.sql("select cast(1 as int) a, cast(1.5 as float) b, array(1) c, 'x' d")
    assert [t for _, t in K.serializable(df).dtypes] == ["bigint", "double", "string", "string"]


def test_a_retried_commit_adds_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "run string, step int")
    path = str(tmp_path / "runs")
    assert catalogue.write_attempt(rows, path, "samples") < catalogue.write_attempt(rows, path, "samples")
    first = catalogue.write_attempt(rows, path, "samples")
    late = catalogue.write_attempt(rows.where("step = 1"), path, "samples")
    # published in the other order: the earlier attempt counts
    catalogue.publish(spark, path, "samples", "one", late)
    catalogue.publish(spark, path, "samples", "one", first)
    catalogue.commit_run(rows.limit(0), path, "samples", "empty")
    catalogue.commit_run(rows.withColumn("step", F.col("step") + 10), path, "samples", "two")
    catalogue.commit_run(rows, path, "trials", "one")
    got = sorted((r.commit, r.run or "", r.step) for r in catalogue.read_kind(spark, path, "samples").collect())
    assert got == [("one", "", 3), ("one", "a", 1), ("one", "a", 2), ("two", "", 13), ("two", "a", 11), ("two", "a", 12)]
    assert {(r.kind, r.commit): r.n_rows for r in catalogue.manifest(spark, path).collect()} == {
        ("samples", "one"): 3, ("samples", "two"): 3, ("samples", "empty"): 0, ("trials", "one"): 3,
    }


def test_catalogue_files_do_not_grow_with_the_runs(spark, tmp_path):
    rows = spark.range(0, 3000, 1, 4).select((F.col("id") % 1000).alias("run"), F.col("id").alias("step"))
    catalogue.commit_run(rows, str(tmp_path / "c"), "samples", "one")
    K.append_run(rows, str(tmp_path / "r"))
    for folder in ("c/samples", "r"):
        assert len(list((tmp_path / folder).rglob("*.parquet"))) <= 4
    back = catalogue.read_kind(spark, str(tmp_path / "c"), "samples")
    assert back.where("run = 7").count() == 3 and back.select("run").distinct().count() == 1000
    assert spark.read.parquet(str(tmp_path / "r")).exceptAll(rows).count() == 0


def test_clustered_files_follow_the_bytes(spark, tmp_path):
    rows = spark.range(20_000).repartition(16).select(F.when(F.col("id") < 18_000, "hot").when(F.col("id") < 19_990, "cold").alias("name"), F.col("id").cast("string").alias("value"))
    written = stage(rows, "rows")
    dealt = catalogue.clustered(written, ["name"], F.lit(100), 200_000)
    # small tasks are not put together here, so that the dealing shows
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt.write.partitionBy("name").text(str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = {}
    for f in (tmp_path / "out").glob("name=*/*.txt"):
        files.setdefault(f.parent.name, []).append(f)
    assert 2 <= len(files["name=hot"]) <= 9 and len(files["name=cold"]) == 1 and len(files["name=__HIVE_DEFAULT_PARTITION__"]) == 1
    assert dealt.count() == 20_000 and dealt.exceptAll(written).count() == 0
    assert dealt.groupBy("name").agg(F.count_distinct("value")).count() == 3


def test_image_files(spark, tmp_path):
    picture = "struct<filename:string,content_type:string,data:binary>"
    rows = [("a", [("x.PNG", "image/png", b"one"), ("y", None, b"")]), ("b", [("x.PNG", "image/png", b"one"), ("z.gif", "image/gif", None)]), ("c", []), (None, [("q.png", None, b"two")])]
    docs = spark.createDataFrame(rows, f"path string, images array<{picture}>").repartition(3)
    path = str(tmp_path / "images")
    write_images(docs, path)
    got = {(r.path, r.filename): (r.file, r.n_bytes, None if r.data is None else bytes(r.data)) for r in read_images(spark, path).collect()}
    assert {k: v[1:] for k, v in got.items()} == {("a", "x.PNG"): (3, b"one"), ("a", "y"): (0, b""), ("b", "x.PNG"): (3, b"one"), ("b", "z.gif"): (None, None), (None, "q.png"): (3, b"two")}
    name = hashlib.sha256(b"one").hexdigest()
    assert got["a", "x.PNG"][0] == got["b", "x.PNG"][0] == f"files/{name[:2]}/{name}.png" and got["b", "z.gif"][0] is None
    stored = lambda: sorted(f.name for f in (tmp_path / "images" / "files").glob("*/*") if not f.name.startswith("."))
    before = stored()
    assert len(before) == 3
    # written again: the same names, nothing besides them
    write_images(docs, path, mode="append")
    assert stored() == before
    write_images(docs.limit(0), str(tmp_path / "none"))
    assert read_images(spark, str(tmp_path / "none")).count() == 0


def test_a_log_run_writes_less_than_twice_its_input(spark, tmp_path):
    import json
    import os

    from logloom.session import shared_folder
    from logloom.sinks.log_run import run_logs

    def size(folder):
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names)

    folder, n = tmp_path / "in", 8000
    folder.mkdir()
    (folder / "a.sql").write_text("".join(f"-- 2024-01-01 10:00:{k % 60:02d}\nselect o.*, c.name from sales.orders o join customer c on c.id = o.cust where o.id = {k};\n" for k in range(n)))
    (folder / "b.jsonl").write_text("".join(json.dumps({"type": "click", "time": f"2024-01-01T10:00:{k % 60:02d}", "user_id": k, "props": {"k": k % 97}}) + "\n" for k in range(n)))
    (folder / "c.csv").write_text("id,name,date\n" + "".join(f"{k},name {k},2024-01-{k % 28 + 1:02d}\n" for k in range(n)))
    shared = shared_folder(spark).removeprefix("file:")
    before = size(shared)
    row = run_logs(spark, str(folder), str(tmp_path / "out")).first()
    # staged tables and the output together
    assert size(shared) - before + size(tmp_path / "out") < 2 * size(folder)
    assert (row.total_entries, row.errors, row.entries_by_format) == (3 * n, 0, {"sql": n, "json": n, "csv": n})
    run_logs(spark, str(folder), str(tmp_path / "plain"), compression="none")
    packed, plain = (spark.read.text(str(tmp_path / x / "entries")) for x in ("out", "plain"))
    assert packed.count() == 3 * n and packed.exceptAll(plain).count() == plain.exceptAll(packed).count() == 0
    assert all(x.endswith(".txt") for x in plain.inputFiles())


def test_tables_read_no_more_are_deleted(spark, tmp_path):
    import os

    from logloom.session import discard, stage

    staged, other = stage(spark.range(3), "gone"), str(tmp_path / "kept")
    spark.range(3).write.parquet(other)
    folder = staged.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(folder)
    discard(staged)
    discard(spark.read.parquet(other))
    assert not os.path.exists(folder) and spark.read.parquet(other).count() == 3
