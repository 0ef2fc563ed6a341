import datetime as dt

import pytest
from pyspark.sql import functions as F

from logloom.functions.timeparse import iso_text, parse_timestamp, time_filter
from logloom.operators import log_entries as L
from logloom.sources.lines import detect_format

T = dt.datetime

CASES = [
    ("2024-01-02T03:04:05", T(2024, 1, 2, 3, 4, 5)),
    ("2024-01-02 03:04:05", T(2024, 1, 2, 3, 4, 5)),
    ("2024-01-02T03:04:05.5", T(2024, 1, 2, 3, 4, 5, 500000)),
    ("2024-01-02T03:04:05+0200", T(2024, 1, 2, 1, 4, 5)),
    ("2024-01-02T03:04:05Z", T(2024, 1, 2, 3, 4, 5)),
    ("2024-01-02T03:04:05.25+02:00", T(2024, 1, 2, 1, 4, 5, 250000)),
    ("2024-01-02", T(2024, 1, 2)),
    ("2024-1-2", T(2024, 1, 2)),
    ("03/04/2024 01:00:00", T(2024, 4, 3, 1)),
    ("12/25/2024 01:00:00", T(2024, 12, 25, 1)),
    ("1704067200", T(2024, 1, 1)),
    ("1704067200000", T(2024, 1, 1)),
    ("1704067200.5", T(2024, 1, 1, 0, 0, 0, 500000)),
    ("10000000000", T(2286, 11, 20, 17, 46, 40)),
    ("1612113001123", T(2021, 1, 31, 17, 10, 1, 123000)),
    ("20240101", T(2024, 1, 1)),
    ("2024-02-30", None),
    ("99999999999999999999999", None),
    ("", None),
    ("junk", None),
    (None, None),
]


def test_parse_timestamp(spark):
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(CASES)], "i int, x string")
    got = {r.x: r.s for r in df.select("x", parse_timestamp(F.col("x")).cast("string").alias("s")).collect()}
    for text, want in CASES:
        have = T.fromisoformat(got[text]) if got[text] else None
        assert have == want, (text, have, want)


def test_custom_formats(spark):
    df = spark.createDataFrame([("05.01.2024 10:00",)], "x string")
    got = df.select(parse_timestamp(F.col("x"), ["%d.%m.%Y %H:%M"]).cast("string").alias("s")).first().s
    assert got == "2024-01-05 10:00:00"


def test_iso_text(spark):
    df = spark.sql("select timestamp'2024-01-02 03:04:05' a, timestamp'2024-01-02 03:04:05.5' b")
    assert df.select(iso_text(F.col("a")), iso_text(F.col("b"))).first()[:] == (
        "2024-01-02T03:04:05",
        "2024-01-02T03:04:05.500000",
    )


def test_time_filter(spark):
    df = spark.createDataFrame(
        [("2024-01-31 23:59:59.999999",), ("2024-02-01 00:00:00",), ("2023-12-31 23:59:59",), (None,)], "x string"
    ).withColumn("ts", F.col("x").cast("timestamp"))
    kept = [r.x for r in df.where(time_filter(F.col("ts"), "2024-01-01", "2024-01-31 10:00:00")).collect()]
    assert kept == ["2024-01-31 23:59:59.999999", None]
    dated = df.where(time_filter(F.col("ts"), "2024-01-01", "2024-01-31", keep_undated=False))
    assert dated.count() == 1
    assert df.where(time_filter(F.col("ts"))).count() == 4


def lines_of(spark, files):
    rows = [(name, 0, i, line) for name, text in files.items() for i, line in enumerate(text.split("\n"))]
    return spark.createDataFrame(rows, "source_file string, chunk bigint, seq bigint, line string")


def test_sql_golden(spark):
    text = (
        "-- 2024-01-01 10:00:00\nSELECT * FROM public.users u JOIN orders o ON u.id=o.uid;\n\n"
        "INSERT INTO t VALUES (';');"
    )
    df = L.sql_entries(L.sql_statements(spark.createDataFrame([("a.sql", text)], "source_file string, text string")))
    a, b = df.orderBy("entry_index").collect()
    assert (a.log_type, a.tables, a.schema, str(a.timestamp), a.timestamp_source) == (
        "SELECT", ["users", "orders"], "public", "2024-01-01 10:00:00", "comment",
    )
    assert (b.log_type, b.tables, b.schema, b.timestamp, b.timestamp_source) == ("INSERT", ["t"], None, None, None)
    assert b.raw_content == "INSERT INTO t VALUES (';');"
    assert a.query_length == len(a.raw_content)


@pytest.mark.parametrize(
    "text,want",
    [
        ("a; b;", ["a;", "b;"]),
        ("a;;b", ["a;", ";", "b"]),
        ("/* x; y */ a; -- c;\nb", ["/* x; y */ a; -- c;", "b"]),
        ("f $$ a; b $$; g $t$ x; $$ $t$;", ["f $$ a; b $$;", "g $t$ x; $$ $t$;"]),
        ('select ";" ; x', ['select ";" ;', "x"]),
        ("select 'it\\'s; ok'; y", ["select 'it\\'s; ok';", "y"]),
        ("a 'open; b", ["a 'open; b"]),
        ("", []),
        (" \n ", []),
        ("a-b; c/d; $1;", ["a-b;", "c/d;", "$1;"]),
    ],
)
def test_split(spark, text, want):
    df = spark.createDataFrame([("f", text)], "source_file string, text string")
    got = [r.statement for r in L.sql_statements(df).orderBy("entry_index").collect()]
    assert got == want


def test_split_is_linear(spark):
    text = "INSERT INTO t VALUES (" + ",".join("'a;b'" for _ in range(20000)) + ");\n" + "x;\n" * 20000
    df = spark.createDataFrame([("f", text)], "source_file string, text string")
    assert L.sql_statements(df).count() == 20001


@pytest.mark.parametrize(
    "stmt,kind,tables,schema",
    [
        ("select a, b from x, y z where a in (1)", "SELECT", ["x", "y"], None),
        ("select extract(year from ts) from logs", "SELECT", ["logs"], None),
        ("with c as (select * from s.base) select * from c join d on 1=1", "SELECT", ["base", "d"], "s"),
        ("with c (k) as (select 1 from q) insert into w select * from c", "INSERT", ["q", "w"], None),
        ("-- from nowhere\n/* into x */ update app.t set a = 'from z'", "UPDATE", ["t"], "app"),
        ("create or replace view v as select 1", "CREATE OR REPLACE", [], None),
        ("create table if not exists a.b (x int)", "CREATE", ["b"], "a"),
        ("explain select 1", "UNKNOWN", [], None),
        ('delete from "Sales"."Orders" where 1=1', "DELETE", ["Orders"], "Sales"),
        ("select 1 from a join a on true", "SELECT", ["a"], None),
        ("-- it's\nselect 1 from k where x = 'b'", "SELECT", ["k"], None),
    ],
)
def test_statement_columns(spark, stmt, kind, tables, schema):
    df = spark.createDataFrame([("f", 0, stmt)], "source_file string, entry_index bigint, statement string")
    row = L.sql_entries(df).first()
    assert (row.log_type, row.tables, row.schema) == (kind, tables, schema)


def test_format_query(spark):
    stmt = "select Id, 'From X' from Users left outer join T on a=b where x = 'y' -- from c\norder by z"
    df = spark.createDataFrame([("f", 0, stmt)], "source_file string, entry_index bigint, statement string")
    assert L.sql_entries(df).first().formatted_query == (
        "SELECT id, 'From X'\nFROM users\nLEFT OUTER JOIN t ON a=b\nWHERE x = 'y' -- from c\nORDER BY z"
    )


def test_json_lines_golden(spark):
    text = "\n".join(
        [
            '{"type":0,"event":"","level":"warn"}',
            '{"time":"junk","date":"2024-01-01"}',
            "",
            "{bad",
            '{"a":[{"x":1}]}',
            "5",
            '{"s":"{not obj","n":{"x":1}}',
            '{"type":true,"@timestamp":1704067200}',
            '{"a":1} trailing',
        ]
    )
    lines = lines_of(spark, {"a.jsonl": text})
    rows = L.json_entries(lines).orderBy("entry_index").collect()
    assert [(r.log_type, r.field_count, r.has_nested_objects, r.timestamp_field, r.entry_index) for r in rows] == [
        ("warn", 3, False, None, 0),
        ("JSON", 2, False, "date", 1),
        ("JSON", 1, False, None, 2),
        ("JSON", 2, True, None, 3),
        ("True", 2, False, "@timestamp", 4),
    ]
    assert L.json_errors(lines).count() == 3
    with pytest.raises(Exception, match="cannot read JSON line"):
        L.json_entries(lines, policy="fail").collect()


def test_json_array(spark):
    df = spark.createDataFrame([("a.json", '[{"type":"x","n":1},{"type":"y"}, 5]')], "source_file string, text string")
    lines = L.json_array_lines(df)
    assert [r.log_type for r in L.json_entries(lines).orderBy("entry_index").collect()] == ["x", "y"]
    assert L.json_errors(lines).count() == 1


def test_csv(spark):
    lines = lines_of(
        spark,
        {
            "a.csv": 'id,time,type,note\n1,2024-01-05,login,"a, ""b"""\n\n2,,0,NA\n3,2024-03-01\n4,x,y,z,extra\n',
            "b.csv": "date;level\n01/02/2024 00:00:00;warn\n",
            "c.csv": "a|b\n1|2\n",
        },
    )
    rows = {(r.source_file, r.entry_index): r for r in L.csv_entries(lines).collect()}
    assert set(rows) == {("a.csv", 0), ("a.csv", 1), ("a.csv", 2), ("b.csv", 0), ("c.csv", 0)}
    first = rows["a.csv", 0]
    assert (first.log_type, first.payload["note"], str(first.timestamp)) == ("login", 'a, "b"', "2024-01-05 00:00:00")
    assert first.raw_content == '1,2024-01-05,login,a, "b"'
    second = rows["a.csv", 1]
    assert (second.log_type, second.payload["note"], second.timestamp_field, second.raw_content) == ("CSV", None, None, "2,,0,")
    assert rows["a.csv", 2].payload == {"id": "3", "time": "2024-03-01", "type": None, "note": None}
    assert str(rows["b.csv", 0].timestamp) == "2024-02-01 00:00:00" and rows["b.csv", 0].log_type == "warn"
    assert rows["c.csv", 0].columns == ["a", "b"]


@pytest.mark.parametrize(
    "name,text,want",
    [
        ("x.SQL", "", "sql"),
        ("x.jsonl", "a", "json"),
        ("x.log", '{"q":"SELECT 1"}', "sql"),
        ("x.log", '{"a":1}', "json"),
        ("x.log", ' \n["a"]', "json"),
        ("x.log", "a,b", "csv"),
        ("x.log", "hello", "sql"),
        ("x.log", "1\n2\n3\n4\n5\nSELECT 1", "sql"),
        ("x.log", "a,1\n2\n3\n4\n5\nSELECT 1", "csv"),
    ],
)
def test_detect_format(spark, name, text, want):
    df = spark.createDataFrame([(name, text)], "n string, t string")
    assert df.select(detect_format(F.col("n"), F.col("t"))).first()[0] == want


def test_entry_json(spark):
    lines = lines_of(spark, {"a.jsonl": '{"type":"é","n":{"x":null}}'})
    out = L.entry_json(L.to_log_entry(L.json_entries(lines), "json")).first().value
    assert out == (
        '{"source_file":"a.jsonl","source_format":"json","log_type":"é","timestamp":null,'
        '"raw_content":"{\\"type\\":\\"é\\",\\"n\\":{\\"x\\":null}}",'
        '"processed_content":{"n":{"x":null},"type":"é"},'
        '"metadata":{"field_count":2,"has_nested_objects":true},"processing_info":{"index":0,"timestamp_field":null}}'
    )


def test_json_truthiness(spark):
    cases = {
        '{"type":"0"}': "0", '{"type":"false"}': "false", '{"type":false,"level":"x"}': "x", '{"type":[],"event":{},"level":null,"severity":0.0,"category":"c"}': "c",
        '{"type":[1]}': "[1]", '{"type":{"a":1}}': '{"a":1}', '{"type":7}': "7", '{"type":null}': "JSON", '{"type":" "}': " ",
    }
    lines = lines_of(spark, {"a": "\n".join(cases)})
    got = [r.log_type for r in L.json_entries(lines).orderBy("entry_index").collect()]
    assert got == list(cases.values())
