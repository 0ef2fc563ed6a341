"""SQL, JSON and CSV log records as one row shape.

Each ``*_entries`` function returns flat, typed columns; :func:`to_log_entry`
wraps them into the envelope with dynamic payload, metadata and info.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions import sqltext
from logloom.functions.paths import file_name
from logloom.functions.text import is_blank, preview, strip
from logloom.functions.timeparse import iso_text, parse_timestamp, time_filter
from logloom.operators.columns import evaluated
from logloom.operators.errors import apply_policy, rejected
from logloom.operators.prefix import running, with_position

# Field names that may hold the time and the type of a record.
TIME_FIELDS = [
    "timestamp", "time", "date", "created_at", "datetime",
    "createdAt", "created", "eventTime", "logTime", "@timestamp",
]
CSV_TIME_FIELDS = TIME_FIELDS[:-1]
TYPE_FIELDS = ["type", "event", "level", "severity", "category"]
# Texts a CSV reader takes as missing.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
DELIMITERS = [",", ";", "\t", "|"]

LINE_KEYS = ["source_file"]

# Text in which a semicolon means nothing. What is never closed runs to the end.
TAG = r"\$[A-Za-z_]\w*+\$"


def _protected(end: str, group: int = 1) -> str:
    """``end`` lets text end while something is open; ``group`` numbers the tag of a dollar body."""
    return (
        rf"""'(?:[^'\\]++|\\(?s:.))*+(?:'{end})|"[^"]*+(?:"{end})|--[^\n]*+|/\*(?s:.*?)(?:\*/{end})"""
        rf"|\$\$(?s:.*?)(?:\$\${end})|\$([A-Za-z_]\w*+)\$(?s:.*?)(?:\$\{group}\${end})"
    )


def _body(group: int) -> str:
    return rf"""(?:{_protected(r"|\z", group)}|[^;'"/$-]++|[^;])*+"""


# One statement; a comment on the line of the semicolon belongs to the statement before.
STATEMENT = rf"(?:{_body(1)};[ \t]*+(?:--[^\n]*+)?)|(?:(?!\z){_body(2)}\z)"
# The longest start of a text after which nothing is open.
CLOSED_PART = rf"""^(?:{_protected("")}|[^'"/$-]++|/(?!\*)|\$(?!\$|[A-Za-z_]\w*+\$)|-)*+"""


# --- SQL -------------------------------------------------------------------


def split_statements(text: Column) -> Column:
    """Statements of a script in order, each with its ``;``; quoted semicolons do not split."""
    return F.regexp_extract_all(text, F.lit(STATEMENT), F.lit(0))


def sql_statements(texts: DataFrame) -> DataFrame:
    """``source_file, text`` -> one row per statement with its index; blanks use up a number."""
    pieces = texts.select("source_file", F.posexplode(split_statements(F.col("text"))).alias("entry_index", "__piece"))
    return pieces.select("source_file", F.col("entry_index").cast("bigint").alias("entry_index"), strip(F.col("__piece")).alias("statement")).where(
        F.col("statement") != ""
    )


def sql_entries(
    statements: DataFrame,
    start: str | None = None,
    end: str | None = None,
    keep_undated: bool = True,
    formats: list[str] | None = None,
) -> DataFrame:
    """``source_file, entry_index, statement`` -> typed SQL entries."""
    stmt = F.col("statement")
    found = statements.withColumn("__text", sqltext.comment_timestamp_text(stmt))
    dated = evaluated(
        found.withColumn("timestamp", parse_timestamp(F.col("__text"), formats)), "timestamp"
    ).where(time_filter(F.col("timestamp"), start, end, keep_undated))
    named = dated.withColumn("__names", sqltext.qualified_tables(stmt)).withColumn(
        "tables", sqltext.table_names(F.col("__names"))
    )
    return named.select(
        "source_file",
        F.lit("sql").alias("source_format"),
        sqltext.statement_type(stmt).alias("log_type"),
        "timestamp",
        stmt.alias("raw_content"),
        sqltext.format_query(stmt).alias("formatted_query"),
        "tables",
        sqltext.first_schema(F.col("__names")).alias("schema"),
        F.length(stmt).cast("bigint").alias("query_length"),
        F.size("tables").cast("bigint").alias("tables_count"),
        "entry_index",
        F.when(F.col("timestamp").isNotNull(), "comment").alias("timestamp_source"),
    )


# --- JSON ------------------------------------------------------------------


def _json_items(line: Column) -> Column:
    """The line as a list of ``map<string,variant>``; a good line gives one map.

    Parsed inside brackets, so text after the object makes the line invalid.
    """
    return F.from_json(F.concat(F.lit("["), line, F.lit("]")), "array<map<string,variant>>")


def _last_values(record: Column) -> Column:
    """A record in which a repeated key keeps its first place and its last value."""
    keys = F.array_distinct(F.map_keys(record))
    last = F.transform(keys, lambda k: F.element_at(F.filter(F.map_entries(record), lambda e: e["key"] == k), -1)["value"])
    return F.when(F.size(keys) < F.size(F.map_keys(record)), F.map_from_arrays(keys, last)).otherwise(record)


def _json_object(line: Column) -> Column:
    items = _json_items(line)
    return F.when(F.size(items) == 1, items[0])


def _first_dated(pairs: list[tuple[str, Column]], formats: list[str] | None) -> Column:
    """First (field, text) whose text parses, as ``struct<field, ts>``.

    Absent fields are dropped before parsing; rows normally hold one or two.
    """
    present = F.filter(
        F.array(*[F.struct(F.lit(n).alias("field"), x.alias("text")) for n, x in pairs]),
        lambda s: s["text"].isNotNull(),
    )
    parsed = F.transform(
        present, lambda s: F.struct(s["field"].alias("field"), parse_timestamp(s["text"], formats).alias("ts"))
    )
    return F.get(F.filter(parsed, lambda s: s["ts"].isNotNull()), F.lit(0))


def _first_truthy(values: list[Column]) -> Column:
    """Text of the first JSON value that is not null, false, zero or an empty string, list or object."""
    shown = F.transform(
        F.filter(F.array(*values), lambda v: v.isNotNull()),
        lambda v: F.struct(F.schema_of_variant(v).alias("kind"), v.cast("string").alias("text")),
    )
    empty = ["false", "[]", "{}"]
    full = F.filter(
        shown,
        lambda s: F.when(s["kind"] == "STRING", s["text"] != "").otherwise(
            ~s["text"].isin(empty) & ~s["text"].rlike(r"^-?0(?:\.0*)?(?:[eE][+-]?\d+)?$")
        ),
    )
    first = F.get(full, F.lit(0))
    return F.when(first["kind"] == "BOOLEAN", "True").otherwise(first["text"])


def json_columns(lines: DataFrame, formats: list[str] | None = None) -> DataFrame:
    """Filled lines with ``__ok, __found`` and the typed columns; works on streams as well."""
    record = F.col("__record")
    filled = lines.where(~is_blank(F.col("line")))
    items = evaluated(filled.withColumn("__record", _json_items(F.col("line"))), "__record")
    # the values are settled here, once for all columns that look at them
    parsed = evaluated(items.withColumn("__record", F.when(F.size("__record") == 1, _last_values(record[0]))), "__record")
    found = _first_dated([(n, F.element_at(record, n).cast("string")) for n in TIME_FIELDS], formats)
    return parsed.select(
        *[c for c in lines.columns if c != "line"],
        F.substr("line", F.lit(1), F.lit(100)).alias("__head"),
        record.isNotNull().alias("__ok"),
        found.alias("__found"),
        F.coalesce(_first_truthy([F.element_at(record, n) for n in TYPE_FIELDS]), F.lit("JSON")).alias("log_type"),
        F.to_json(record).alias("raw_content"),
        F.size(F.array_distinct(F.map_keys(record))).cast("bigint").alias("field_count"),
        F.exists(F.map_values(record), lambda v: F.startswith(F.schema_of_variant(v), F.lit("OBJECT"))).alias("has_nested_objects"),
    )


def json_entries(
    lines: DataFrame,
    start: str | None = None,
    end: str | None = None,
    keep_undated: bool = True,
    policy: str = "skip",
    formats: list[str] | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Line table -> typed JSON entries, one per readable line; ``rows`` says about how many lines there are."""
    typed = json_columns(lines, formats)
    indexed = evaluated(
        with_position(typed, LINE_KEYS, "chunk", ["seq"], "entry_index", counted=F.col("__ok"), rows=rows), "__found"
    )
    good = apply_policy(
        indexed, F.col("__ok"), policy, F.concat(F.lit("cannot read JSON line: "), preview(F.col("__head")))
    )
    return good.where(time_filter(F.col("__found.ts"), start, end, keep_undated)).select(
        "source_file",
        F.lit("json").alias("source_format"),
        "log_type",
        F.col("__found.ts").alias("timestamp"),
        "raw_content",
        "field_count",
        "has_nested_objects",
        "entry_index",
        F.col("__found.field").alias("timestamp_field"),
    )


def json_errors(lines: DataFrame) -> DataFrame:
    """Lines that are not one JSON object, with a preview."""
    filled = lines.where(~is_blank(F.col("line")))
    bad = rejected(filled, _json_object(F.col("line")).isNotNull())
    return bad.select("source_file", "seq", preview(F.col("line")).alias("error"))


def json_array_lines(texts: DataFrame) -> DataFrame:
    """Files that hold one JSON array -> line table with one element per line."""
    elements = texts.select(
        "source_file", F.posexplode(F.from_json("text", "array<variant>")).alias("seq", "__v")
    )
    return elements.select(
        "source_file",
        F.lit(0).cast("bigint").alias("chunk"),
        F.col("seq").cast("bigint").alias("seq"),
        F.to_json("__v").alias("line"),
    )


# --- CSV -------------------------------------------------------------------


def detect_delimiter(header: Column) -> Column:
    """The most frequent of comma, semicolon, tab and bar in the header; comma on a tie."""
    counts = F.array(
        *[
            F.struct(F.regexp_count(header, F.lit("\\" + d if d == "|" else d)).alias("n"), F.lit(-i).alias("rank"))
            for i, d in enumerate(DELIMITERS)
        ]
    )
    best = -F.array_max(counts)["rank"]
    return F.element_at(F.array(*[F.lit(d) for d in DELIMITERS]), best + 1)


def csv_fields(line: Column, delimiter: Column) -> Column:
    """Fields of one CSV line with quotes resolved."""
    d = F.when(delimiter == "|", r"\|").otherwise(delimiter)
    pattern = F.concat(d, F.lit(r'("(?:[^"]++|"")*+"|[^'), d, F.lit("]*+)"))
    fields = F.regexp_extract_all(F.concat(delimiter, line), pattern, F.lit(1))
    return F.transform(
        fields,
        lambda x: F.when(
            F.startswith(x, F.lit('"')) & F.endswith(x, F.lit('"')) & (F.length(x) > 1),
            F.replace(F.substr(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"')),
        ).otherwise(x),
    )


def distinct_names(names: Column) -> Column:
    """Repeated column names get the next free number: ``a, a`` become ``a, a.1``; with ``a.1`` in the header, ``a.2``."""

    def numbered(all_names: Column) -> Column:
        def one(name: Column, i: Column) -> Column:
            before = F.size(F.filter(F.slice(all_names, F.lit(1), i), lambda other: other == name))
            tries = F.transform(F.sequence(F.lit(1), F.size(all_names)), lambda k: F.concat(name, F.lit("."), k.cast("string")))
            free = F.filter(tries, lambda x: ~F.array_contains(all_names, x))
            return F.when(before > 0, F.get(free, before - 1)).otherwise(name)

        return F.transform(all_names, one)

    # the one-element array binds the names once
    return F.get(F.transform(F.array(names), numbered), F.lit(0))


def csv_records(lines: DataFrame) -> DataFrame:
    """Line table with header rows -> ``columns, values`` and ``entry_index`` per data row.

    The header reaches every chunk of its file through the per-chunk totals, so
    no join is keyed on the file.
    """
    filled = lines.where(~is_blank(F.col("line")))
    carried = running(
        filled,
        LINE_KEYS,
        "chunk",
        ["seq"],
        __pos=("sum", F.lit(1).cast("bigint")),
        __header=("first", F.struct("chunk", "seq", "line")),
    )
    delimited = evaluated(
        carried.where("__pos > 0").withColumn("__delimiter", detect_delimiter(F.col("__header.line"))), "__delimiter"
    )
    fields = delimited.select(
        *[c for c in lines.columns if c != "line"],
        (F.col("__pos") - 1).alias("entry_index"),
        distinct_names(csv_fields(F.col("__header.line"), F.col("__delimiter"))).alias("columns"),
        csv_fields(F.col("line"), F.col("__delimiter")).alias("__raw"),
    )
    return evaluated(fields, "columns", "__raw").withColumn("ok", F.size("__raw") <= F.size("columns"))


def csv_entries(
    lines: DataFrame,
    start: str | None = None,
    end: str | None = None,
    keep_undated: bool = True,
    policy: str = "skip",
    formats: list[str] | None = None,
) -> DataFrame:
    """Line table of CSV files -> typed entries; missing texts become null."""
    records = apply_policy(csv_records(lines), F.col("ok"), policy, F.lit("CSV row has more fields than its header"))
    padded = F.transform(
        F.col("columns"),
        lambda _, i: F.when(~F.coalesce(F.get("__raw", i), F.lit("")).isin(MISSING), F.get("__raw", i)),
    )
    rows = evaluated(records.withColumn("values", padded), "values").withColumn(
        "payload", F.map_from_arrays("columns", "values")
    )

    def value(name: str) -> Column:
        return F.get("values", (F.array_position("columns", F.lit(name)) - 1).cast("int"))

    def truthy(x: Column) -> Column:
        zero = x.rlike(r"^[+-]?0+(?:\.0*)?$") | F.lower(x).isin("false")
        return F.when((x != "") & ~zero, x)

    found = _first_dated([(n, value(n)) for n in CSV_TIME_FIELDS], formats)
    dated = evaluated(rows.withColumn("__found", found), "__found").where(time_filter(F.col("__found.ts"), start, end, keep_undated))
    return dated.select(
        "source_file",
        F.lit("csv").alias("source_format"),
        F.coalesce(*[truthy(value(n)) for n in TYPE_FIELDS], F.lit("CSV")).alias("log_type"),
        F.col("__found.ts").alias("timestamp"),
        F.array_join(F.transform("values", lambda x: F.coalesce(x, F.lit(""))), ",").alias("raw_content"),
        "payload",
        F.size("columns").cast("bigint").alias("column_count"),
        "columns",
        "entry_index",
        F.col("__found.field").alias("timestamp_field"),
    )


# --- envelope --------------------------------------------------------------

ENTRY_COLUMNS = [
    "source_file", "source_format", "log_type", "timestamp", "raw_content",
    "processed_content", "metadata", "processing_info",
]


def _variant(**fields: str) -> Column:
    return F.to_variant_object(F.struct(*[F.col(c).alias(n) for n, c in fields.items()]))


def to_log_entry(entries: DataFrame, source_format: str, keep: list[str] | None = None) -> DataFrame:
    """Typed entries of one format -> the common envelope (``dict`` fields as VARIANT); ``keep=["path"]`` adds the whole path."""
    if source_format == "sql":
        payload = _variant(formatted_query="formatted_query", tables="tables", schema="schema")
        metadata = _variant(query_length="query_length", tables_referenced="tables_count")
        info = _variant(index="entry_index", timestamp_source="timestamp_source")
    elif source_format == "json":
        payload = F.try_parse_json("raw_content")
        metadata = _variant(field_count="field_count", has_nested_objects="has_nested_objects")
        info = _variant(index="entry_index", timestamp_field="timestamp_field")
    elif source_format == "csv":
        payload = F.to_variant_object(F.col("payload"))
        metadata = _variant(column_count="column_count", columns="columns")
        info = _variant(index="entry_index", timestamp_field="timestamp_field")
    else:
        raise ValueError(f"unsupported format: {source_format}")
    return entries.select(
        file_name(F.col("source_file")).alias("source_file"),
        "source_format",
        "log_type",
        "timestamp",
        "raw_content",
        payload.alias("processed_content"),
        metadata.alias("metadata"),
        info.alias("processing_info"),
        *[F.col("source_file").alias(c) for c in keep or []],
    )


def entry_json(entry: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One JSON text per entry, null fields kept and the time in ISO form; the columns of ``keep`` stay beside it."""
    shown = entry.withColumn("timestamp", iso_text(F.col("timestamp")))
    body = F.to_json(F.struct(*[F.col(c) for c in ENTRY_COLUMNS]), {"ignoreNullFields": "false"})
    return shown.select("source_format", "source_file", body.alias("value"), *(keep or []))
