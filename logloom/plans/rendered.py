"""The given tables written as log text, so the log operators run on real rows.

Each function keeps every row of its table. Positions come from the table's own
key, and ``chunk`` is a fixed-width range of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.operators.log_entries import TIME_FIELDS, TYPE_FIELDS

# Rows per key range. Offsets are one row per range: 10^12 rows give 2 * 10^7 of them.
CHUNK = 50_000


def chunk_of(key: Column) -> Column:
    """Start of the fixed-width key range a row falls in."""
    return key - key % CHUNK


def _quoted(x: Column) -> Column:
    return F.concat(F.lit('"'), x, F.lit('"'))


def time_text(ts: Column, style: Column) -> Column:
    """One timestamp in nine notations; style 8 has none."""
    shifted = ts + F.expr("interval 2 hours")
    return (
        F.when(style == 0, _quoted(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")))
        .when(style == 1, _quoted(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")))
        .when(style == 2, _quoted(F.date_format(shifted, "yyyy-MM-dd'T'HH:mm:ss'+0200'")))
        .when(style == 3, _quoted(F.date_format(ts, "yyyy-MM-dd HH:mm:ss")))
        .when(style == 4, _quoted(F.date_format(ts, "yyyy-MM-dd")))
        .when(style == 5, _quoted(F.date_format(ts, "dd/MM/yyyy HH:mm:ss")))
        .when(style == 6, F.unix_seconds(ts).cast("string"))
        .when(style == 7, F.unix_millis(ts).cast("string"))
        .otherwise("null")
    )


def event_lines(events: DataFrame) -> DataFrame:
    """One JSON log line per event in a file per event type; every 97th line is cut short."""
    id_ = F.col("event_id")
    time_field = F.element_at(F.array(*[F.lit(x) for x in TIME_FIELDS]), (id_ % 10 + 1).cast("int"))
    type_field = F.element_at(F.array(*[F.lit(x) for x in TYPE_FIELDS]), (id_ % 5 + 1).cast("int"))
    whole = F.concat(
        F.lit("{"),
        F.when(id_ % 5 > 0, F.lit('"type":"",')).otherwise(""),
        _quoted(type_field), F.lit(":"), _quoted(F.col("event_type")), F.lit(","),
        _quoted(time_field), F.lit(":"), time_text(F.col("ts"), id_ % 9), F.lit(","),
        F.lit('"user_id":'), F.col("user_id").cast("string"), F.lit(","),
        F.lit('"tags":[{"n":1}],'),
        F.when(id_ % 2 == 0, F.concat(F.lit('"props":'), F.col("props"))).otherwise(
            F.concat(F.lit('"props":'), _quoted(F.replace("props", F.lit('"'), F.lit('\\"'))))
        ),
        F.lit("}"),
    )
    return events.select(
        F.concat("event_type", F.lit(".jsonl")).alias("source_file"),
        chunk_of(id_).alias("chunk"),
        id_.alias("seq"),
        F.when(id_ % 97 == 0, F.left(whole, F.lit(20))).otherwise(whole).alias("line"),
    )


# What a reader of the lines above must get back, in SQL over ``events``.
EVENT_SQL = """
rendered AS (
  SELECT event_id, event_type || '.jsonl' AS source_file, event_type AS log_type,
    CASE event_id % 9
      WHEN 1 THEN ts WHEN 4 THEN date_trunc('day', ts) WHEN 7 THEN date_trunc('milliseconds', ts)
      WHEN 8 THEN NULL ELSE date_trunc('second', ts) END AS "timestamp",
    CASE WHEN event_id % 9 < 8 THEN list_extract(['timestamp','time','date','created_at','datetime',
      'createdAt','created','eventTime','logTime','@timestamp'], (event_id % 10 + 1)::INT) END AS timestamp_field,
    CASE WHEN event_id % 5 > 0 THEN 6 ELSE 5 END::BIGINT AS field_count,
    event_id % 2 = 0 AS has_nested_objects,
    event_id % 97 = 0 AS bad
  FROM events),
entries AS (
  SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY event_id) - 1 AS entry_index
  FROM rendered WHERE NOT bad)
"""


def order_statements(orders: DataFrame) -> DataFrame:
    """One commented SQL statement per order: ``source_file, pos, statement``."""
    key = F.col("o_orderkey").cast("string")
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    body = (
        F.when(
            F.col("o_orderstatus") == "F",
            F.concat(F.lit("SELECT o.*, c.c_name FROM sales.orders o JOIN customer c ON c.id = o.cust WHERE o.id = "), key),
        )
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("update orders set note = 'pending' where id = "), key))
        .otherwise(F.concat(F.lit("INSERT INTO audit.order_log VALUES ("), key, F.lit(")")))
    )
    return orders.select(
        F.concat(F.lit("cust_"), F.col("o_custkey").cast("string"), F.lit(".sql")).alias("source_file"),
        F.col("o_orderkey").alias("pos"),
        F.concat(
            F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("-- "), stamp, F.lit("\n"))).otherwise(""), body
        ).alias("statement"),
        "o_orderdate",
        "o_orderstatus",
    )


def order_scripts(orders: DataFrame) -> DataFrame:
    """One SQL script per customer (``source_file, text``), statements in key order."""
    return (
        order_statements(orders)
        .groupBy("source_file")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "statement"))).alias("__all"))
        .select(
            "source_file",
            F.concat(F.array_join(F.transform("__all", lambda x: x["statement"]), ";\n"), F.lit(";\n")).alias("text"),
        )
    )


ORDER_SQL = """
statements AS (
  SELECT o_orderkey, 'cust_' || o_custkey || '.sql' AS source_file,
    CASE o_orderstatus WHEN 'F' THEN 'SELECT' WHEN 'O' THEN 'UPDATE' ELSE 'INSERT' END AS log_type,
    CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS "timestamp",
    CASE o_orderstatus WHEN 'F' THEN 'orders,customer' WHEN 'O' THEN 'orders' ELSE 'order_log' END AS tables,
    CASE o_orderstatus WHEN 'F' THEN 'sales' WHEN 'O' THEN NULL ELSE 'audit' END AS "schema",
    (CASE o_orderstatus WHEN 'F' THEN 2 ELSE 1 END)::BIGINT AS tables_count,
    CASE WHEN o_orderpriority <> '5-LOW' THEN '-- ' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || chr(10) ELSE '' END ||
    CASE o_orderstatus
      WHEN 'F' THEN 'SELECT o.*, c.c_name FROM sales.orders o JOIN customer c ON c.id = o.cust WHERE o.id = ' || o_orderkey
      WHEN 'O' THEN 'update orders set note = ''pending'' where id = ' || o_orderkey
      ELSE 'INSERT INTO audit.order_log VALUES (' || o_orderkey || ')' END || ';' AS raw_content,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS entry_index
  FROM orders)
"""


def customer_lines(customer: DataFrame, comma_only: bool = False) -> DataFrame:
    """One delimited file per market segment; the delimiter differs between files."""
    segment = F.col("c_mktsegment")
    d = F.lit(",") if comma_only else F.when(segment == "BUILDING", ";").when(segment == "MACHINERY", "\t").when(segment == "HOUSEHOLD", "|").otherwise(",")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 60).cast("int"))
    data = customer.select(
        F.concat(segment, F.lit(".csv")).alias("source_file"),
        chunk_of(F.col("c_custkey")).alias("chunk"),
        F.col("c_custkey").alias("seq"),
        F.call_function(
            "concat_ws",
            d,
            F.col("c_custkey").cast("string"),
            _quoted(F.concat("c_name", F.lit(', "'), d, F.lit('"'))).alias("q"),
            F.when(F.col("c_custkey") % 7 == 0, "").otherwise(F.date_format(day, "yyyy-MM-dd")),
            F.when(F.col("c_custkey") % 11 == 0, "0").otherwise(F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string"))),
            F.when(F.col("c_acctbal") < 0, "NA").otherwise("ok"),
        ).alias("line"),
    )
    # quotes inside a quoted field are doubled
    data = data.withColumn("line", F.regexp_replace("line", r'(, )"(.)""', '$1""$2"""'))
    header = customer.select(
        F.concat(segment, F.lit(".csv")).alias("source_file"),
        F.lit(0).cast("bigint").alias("chunk"),
        F.lit(-1).cast("bigint").alias("seq"),
        F.call_function("concat_ws", d, *[F.lit(x) for x in ("id", "name", "date", "category", "status")]).alias("line"),
    ).distinct()
    return header.unionByName(data)


CUSTOMER_SQL = """
delimited AS (
  SELECT c_custkey, c_mktsegment || '.csv' AS source_file,
    CASE c_mktsegment WHEN 'BUILDING' THEN ';' WHEN 'MACHINERY' THEN chr(9) WHEN 'HOUSEHOLD' THEN '|' ELSE ',' END AS d,
    CASE WHEN c_custkey % 7 > 0 THEN (DATE '2024-01-01' + (c_custkey % 60)::INT)::TIMESTAMP END AS "timestamp",
    CASE WHEN c_custkey % 11 > 0 THEN 'nation_' || c_nationkey ELSE 'CSV' END AS log_type,
    CASE WHEN c_acctbal >= 0 THEN 'ok' END AS status,
    CASE WHEN c_custkey % 11 > 0 THEN 'nation_' || c_nationkey ELSE '0' END AS category,
    row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1 AS entry_index,
    c_name
  FROM customer),
csv_rows AS (
  SELECT *, c_custkey || ',' || c_name || ', "' || d || '",' || coalesce(strftime("timestamp", '%Y-%m-%d'), '') || ',' ||
    category || ',' || coalesce(status, '') AS raw_content
  FROM delimited)
"""
