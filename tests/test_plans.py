"""Properties of physical plans that small data would not show."""

import re

import pytest

from logloom.plans import catalog

QUERIES, ORACLE = catalog.queries(), catalog.oracle_sql()
# queries that parse files or write before they read; their plans are not built here
EAGER = re.compile("scan_|sink|stream_|run_catalogue|evaluation_report")
# Python workers are expected only where a file format is parsed, in stemming and in the subsequence length
PYTHON = re.compile("html_|word_|find_documents_capped|document_metadata|document_images|rouge_l|rouge_stemmed|domain_summarization|headline_summary")


def plan(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not EAGER.search(n)))
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if not PYTHON.search(name):
        assert not re.search("ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas", text)


def test_grams_are_not_shuffled(spark, sf_dir):
    text = plan(spark, sf_dir, "rouge_1_2")
    assert not re.search(r"Exchange hashpartitioning\([^)]*gram", text)


def test_rank_is_limited_before_the_shuffle(spark, sf_dir):
    assert re.search(r"WindowGroupLimit .*Partial", plan(spark, sf_dir, "checkpoint_rotation"))


def test_filter_does_not_repeat_parsing(spark, sf_dir):
    assert plan(spark, sf_dir, "log_daily_types").count("from_json") == 1
    assert plan(spark, sf_dir, "csv_log_time_filter").count("regexp_extract_all") < 10


def test_scans_read_only_what_is_used(spark, sf_dir):
    text = plan(spark, sf_dir, "train_val_test_split")
    assert "ReadSchema: struct<doc_id:bigint>" in text
    assert re.search(r"PushedFilters: \[.*\(role,assistant\)", plan(spark, sf_dir, "pair_alignment").replace("EqualTo", ""))


def test_sql_columns_look_at_a_statement_once(spark):
    from pyspark.sql import functions as F

    from logloom.functions import sqltext

    stmt = F.col("s")
    shown = lambda c: spark.createDataFrame([], "s string").select(c.alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    names, kind, text = (shown(f(stmt)) for f in (sqltext.qualified_tables, sqltext.statement_type, sqltext.format_query))
    assert names.count("extract|substring") == 1
    assert kind.count("CREATE OR REPLACE") == 1 and kind.count(r"(\w+)") == 1
    assert text.count("upper(") == 1


def test_common_times_are_cast_with_the_same_result(spark):
    from pyspark.sql import functions as F

    from logloom.functions.timeparse import DEFAULT_FORMATS, parse_timestamp

    texts = ["2024-01-05T10:11:12", "2024-01-05 10:11:12", "2024-01-05 10:11:12.123456", "2024-01-05T10:11:12.000001", "2024-02-30 10:11:12",
             "2024-01-05 24:00:00", "2024-01-05 10:11:60", "2024-1-5 1:1:1", "2024-01-05", "05/01/2024 10:11:12", "1700000000", "0000-01-01 00:00:00", None]
    x = F.col("x")
    rows = spark.createDataFrame([(t,) for t in texts], "x string").select("x", parse_timestamp(x).cast("string").alias("now"), parse_timestamp(x, DEFAULT_FORMATS).cast("string").alias("parsed"))
    assert all(r.now == r.parsed for r in rows.collect())
    # one cast for these shapes, one for the ISO shapes after the formats
    assert rows.select("now")._jdf.queryExecution().optimizedPlan().toString().count("as timestamp)") == 2


def test_lines_and_script_texts_are_not_moved_to_meet_small_tables(spark, tmp_path):
    import random

    from logloom.operators.sql_scripts import statements_from_lines
    from logloom.sources import lines as S

    rng = random.Random(3)
    (tmp_path / "a.sql").write_text("".join(f"select {rng.getrandbits(300)};\nselect ';\n';\n" for _ in range(2000)))
    (tmp_path / "b.csv").write_text("id\n1\n")
    lines = S.read_lines(spark, str(tmp_path))
    shown = lambda df: df._jdf.queryExecution().executedPlan().toString()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # the lines are many times this, a row per file or block is less
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    try:
        formats, statements = S.file_formats(lines), statements_from_lines(lines.where("source_file like '%.sql'"))
        # the one join left is that of both results, which have a row per file
        assert shown(formats).count("SortMergeJoin") == 1
        assert "SortMergeJoin" not in shown(statements) and "Window" not in shown(statements)
        assert statements.count() == 4000 and formats.count() == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
