import random
from collections import Counter

from pyspark.sql import functions as F

from logloom.operators import log_entries as L
from logloom.operators import log_reports as R
from logloom.operators import prefix, sql_scripts
from logloom.operators.csv_quotes import join_quoted_lines
from logloom.operators.json_texts import json_layout, json_values
from logloom.sources import lines as S
from logloom.sources import logs as G
from tests.test_logs import lines_of


def write(folder, **files):
    for name, text in files.items():
        (folder / name.replace("__", ".")).write_text(text, encoding="utf-8", newline="")
    return str(folder)


def test_folder_scan(spark, tmp_path):
    path = write(
        tmp_path,
        a__sql="-- 2024-01-01 10:00:00\nselect 1 from t;\ninsert into u values (';\n');\n",
        b__json='{"a":1}\n{bad\n{"type":"x"}\n',
        c__csv="id,date\n1,2020-01-01\n2,2020-01-02\n",
        d__json='[\n {"type": "p", "n": [1, "],{"]},\n {"type": "q"}, {"type": "r"}\n]\n',
        e__json='{\n  "type": "pretty",\n  "n": {"x": 1}\n}\n',
        f__log='{"level":"warn"}\n',
        noext="select 1;",
    )
    (tmp_path / ".hidden.sql").write_text("select 1;")
    rows = G.read_log_entries(spark, path).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.source_file, r.entry_index)):
        got.setdefault(r.source_file, []).append(r.log_type)
    assert got == {
        "a.sql": ["SELECT", "INSERT"],
        "b.json": ["JSON", "x"],
        "c.csv": ["CSV", "CSV"],
        "d.json": ["p", "q", "r"],
        "e.json": ["pretty"],
        "f.log": ["warn"],
    }
    assert [r.entry_index for r in sorted(rows, key=lambda r: r.entry_index) if r.source_file == "d.json"] == [0, 1, 2]
    # an explicit format overrides detection
    forced = G.read_log_entries(spark, f"{path}/f.log", source_format="csv")
    assert forced.count() == 0
    envelopes = G.read_log_envelopes(spark, path)
    assert envelopes.count() == len(rows)

    # all rows of c.csv are outside the range: the file counts as an error
    kept = G.read_log_entries(spark, path, start="2024-01-01")
    files = S.list_files(spark, path).select(F.element_at(F.split("source_file", "/"), -1).alias("source_file"))
    stats = R.processing_stats(files, kept).first()
    assert (stats.total_files, stats.processed_files, stats.total_entries, stats.errors) == (6, 5, 9, 1)
    assert stats.entries_by_format == {"sql": 2, "json": 7, "csv": 0}


def test_statements_from_lines_match_whole_text(spark):
    rng = random.Random(7)
    bits = ["select 'a;b", "'", '"', "; ", "\n", "-- c; '\n", "/* ; ' \n", "*/", "$$", "$a$", "$b$ ", "x", "it''s", ";\n", "\\'", "a/b-c "]
    texts = {f"f{i}.sql": "".join(rng.choice(bits) for _ in range(rng.randint(1, 60))) for i in range(60)}
    # \z differs from $ here: a text without a final newline must give the same statements
    whole = L.sql_statements(spark.createDataFrame(list(texts.items()), "source_file string, text string"))
    rows = [
        (name, (i // 5) * 5, i, line) for name, text in texts.items() for i, line in enumerate(text.split("\n"))
    ]
    lines = spark.createDataFrame(rows, "source_file string, chunk bigint, seq bigint, line string")
    before, sql_scripts.BLOCK_LINES = sql_scripts.BLOCK_LINES, 2
    try:
        by_lines = sql_scripts.statements_from_lines(lines)
        got = sorted(map(tuple, by_lines.select("source_file", "entry_index", "statement").collect()))
    finally:
        sql_scripts.BLOCK_LINES = before
    want = sorted(map(tuple, whole.select("source_file", "entry_index", "statement").collect()))
    assert got == want


def test_tagged_bodies_across_blocks(spark, tmp_path, monkeypatch):
    body = "create function f() as $fn$\nbegin;\n select 1;\nend;\n$fn$ language sql;\nselect 2;\n"
    path = write(tmp_path, a__sql=body * 20, b__sql="drop table x;\r\nselect ';\r\n' from b;")
    monkeypatch.setattr(sql_scripts, "BLOCK_LINES", 3)
    got = G.read_sql_statements(spark, path).orderBy("source_file", "entry_index").collect()
    assert [r.statement for r in got[:2]] == [body[: body.index("select 2")].strip(), "select 2;"] and len(got) == 42
    assert [r.statement for r in got[40:]] == ["drop table x;", "select ';\n' from b;"]


def test_comma_first_arrays_are_cut_by_value(spark):
    lines = [("a.json", (i // 4) * 4, i, ("[" if i == 0 else ", ") + '{"k": %d}' % i) for i in range(30)] + [("a.json", 28, 30, "]")]
    values = json_values(spark.createDataFrame(lines, "source_file string, chunk bigint, seq bigint, line string"), "array")
    found = [r.line for r in values.orderBy("chunk", "seq").collect()]
    assert [x for x in found if x != "null"][:30] == ['{"k":%d}' % i for i in range(30)]


def test_tasks_over_json_values_do_not_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(prefix, "TASK_ROWS", 25)
    rows = [(f"f{f}.json", (i // 8) * 8, i, line) for f in range(50) for i, line in enumerate(["[", '{"k": 0}'] + [', {"k": %d}' % k for k in range(1, 20)] + ["]"])]
    values = json_values(spark.createDataFrame(rows, "source_file string, chunk bigint, seq bigint, line string"), "array")
    entries = L.json_entries(values, rows=values.count())
    found = entries.select("source_file", "entry_index", "raw_content", F.spark_partition_id().alias("task")).collect()
    assert {(r.source_file, r.entry_index, r.raw_content) for r in found} == {(f"f{f}.json", k, '{"k":%d}' % k) for f in range(50) for k in range(20)}
    assert max(Counter(r.task for r in found).values()) < 100


def test_stray_quote_keeps_the_other_rows(spark):
    text = 'x,y\n1,2\n"3,4\n' + "\n".join(f"{k},ok" for k in range(50))
    rows = L.csv_records(join_quoted_lines(lines_of(spark, {"a.csv": text}))).collect()
    assert sum(r["__raw"][-1] == "ok" for r in rows) == 50


def test_repeated_header_names(spark):
    r = L.csv_entries(lines_of(spark, {"a.csv": "a,b,a,a\n1,2,3,4"})).first()
    assert r["columns"] == ["a", "b", "a.1", "a.2"] and r.payload["a.2"] == "4"


def test_json_values_across_chunks(spark):
    items = ['{"k": %d, "t": [1, {"x": "}],"}]}' % i for i in range(40)]
    pretty = "[\n" + ",\n".join(x.replace(", ", ",\n  ") for x in items) + "\n]"
    rows = [("a.json", (i // 3) * 3, i, line) for i, line in enumerate(pretty.split("\n"))]
    lines = spark.createDataFrame(rows, "source_file string, chunk bigint, seq bigint, line string")
    entries = L.json_entries(json_values(lines, "array")).orderBy("entry_index").collect()
    assert [r.raw_content for r in entries] == ['{"k":%d,"t":[1,{"x":"}],"}]}' % i for i in range(40)]
    one_line = lines_of(spark, {"a.json": "[" + ", ".join(items) + "]"})
    assert L.json_entries(json_values(one_line, "array")).count() == 40


def test_json_layout(spark):
    cases = {"[": "array", '[{"a":1}]': "array", "{": "object", '{"a":': "lines", '{"a": {': "object", '{"a":1}': "lines", "{bad": "lines"}
    df = spark.createDataFrame([(x,) for x in cases], "x string")
    assert {r.x: r.l for r in df.select("x", json_layout(F.col("x")).alias("l")).collect()} == cases


def test_quoted_line_breaks(spark):
    import csv
    import io
    import random

    rng = random.Random(5)
    values = ["a", 'say "x"', "two\nlines", "c,d", "", "\n", 'q"', "e;f"]
    files = {}
    for f in range(12):
        out = io.StringIO()
        rows = [[rng.choice(values) for _ in range(3)] for _ in range(rng.randint(1, 25))]
        csv.writer(out, lineterminator="\n").writerows([["x", "y", "z"], *rows])
        files[f"f{f}.csv"] = (out.getvalue(), rows)
    table = [
        (name, (i // 4) * 4, i, line) for name, (text, _) in files.items() for i, line in enumerate(text.rstrip("\n").split("\n"))
    ]
    lines = spark.createDataFrame(table, "source_file string, chunk bigint, seq bigint, line string")
    got = {}
    for r in L.csv_records(join_quoted_lines(lines)).orderBy("source_file", "entry_index").collect():
        got.setdefault(r.source_file, []).append(r["__raw"])
    for name, (text, rows) in files.items():
        # a row of three empty fields is ",,", never a blank line
        assert got.get(name, []) == rows, name
    odd = lines_of(spark, {"a.csv": 'x,y\n5" pipe,1\nz,2'})
    assert join_quoted_lines(odd).count() == 3


def test_names_that_clash_with_numbered_ones(spark):
    from logloom.operators.log_entries import distinct_names

    cases = {"id,id,id.1": "id,id.2,id.1", "a,a,a": "a,a.1,a.2", "a.1,a,a,a": "a.1,a,a.2,a.3", "a,b": "a,b", "a,a,a.1,a.1,a.2": "a,a.3,a.1,a.1.1,a.2"}
    df = spark.createDataFrame(list(cases.items()), "names string, want string")
    got = df.select("want", F.array_join(distinct_names(F.split("names", ",")), ",").alias("got")).collect()
    assert all(r["got"] == r["want"] for r in got), got


def test_repeated_json_keys_keep_the_last_value(spark):
    from logloom.operators.log_entries import json_entries

    lines = ['{"type":"a","x":1,"type":"b","x":{"y":2}}', '{"type":"only"}', '{"x":1,"x":null}']
    df = spark.createDataFrame([("f.jsonl", 0, k, x) for k, x in enumerate(lines)], "source_file string, chunk long, seq long, line string")
    got = {r["entry_index"]: r for r in json_entries(df).collect()}
    assert (got[0]["log_type"], got[0]["raw_content"], got[0]["field_count"], got[0]["has_nested_objects"]) == ("b", '{"type":"b","x":{"y":2}}', 2, True)
    assert got[1]["log_type"] == "only" and got[2]["field_count"] == 1


def test_a_log_run_counts_and_times(spark, tmp_path):
    import datetime as dt
    import json

    from logloom.sinks.log_run import by_format, run_logs

    (tmp_path / "in").mkdir()
    for name, text in {"a.sql": "SELECT 1;\nDELETE FROM t;", "b.jsonl": '{"x":1}\n{"x":', "c.csv": "id,n\n1,2\n3,4\n", "d.json": "{broken}", "e.log": ""}.items():
        (tmp_path / "in" / name).write_text(text)
    ticks = iter([dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 10, 0, 5)])
    row = by_format(run_logs(spark, str(tmp_path / "in"), str(tmp_path / "out"), now=lambda: next(ticks))).first()
    assert (row["total_files"], row["processed_files"], row["total_entries"], row["errors"]) == (5, 3, 5, 2)
    assert (row["entries_sql"], row["entries_json"], row["entries_csv"]) == (2, 1, 2)
    assert row["duration_seconds"] == 5 and row["start_time"] == "2024-01-01T10:00:00"
    lines = [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "out" / "entries")).select("value").collect()]
    assert sorted(x["source_file"] for x in lines) == ["a.sql", "a.sql", "b.jsonl", "c.csv", "c.csv"] and all("path" not in x for x in lines)
    assert spark.read.json(str(tmp_path / "out" / "stats")).first()["total_entries"] == 5


def test_csv_without_line_breaks_is_split(spark, tmp_path):
    from logloom.sources.datasets import load_dataset

    path = tmp_path / "rows.csv"
    path.write_text("id,text\n" + "".join(f'{i},"a, ""{i}"""\n' for i in range(20000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        whole, split = (load_dataset(spark, str(path), schema="id long, text string", multi_line=m) for m in (True, False))
        assert whole.rdd.getNumPartitions() == 1 and split.rdd.getNumPartitions() > 3
        assert whole.exceptAll(split).count() == split.exceptAll(whole).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
