"""Dataset building and validation over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions import paths, text
from logloom.operators import dataset as D
from logloom.operators import log_entries as L
from logloom.plans import rendered
from logloom.plans.registry import query
from logloom.plans.rendered import ORDER_SQL, chunk_of


def _digits(prefix: str) -> str:
    """SQL for the first eight hexadecimal digits of md5(prefix || key) as a number modulo 1000."""
    return f"(('0x' || left(md5({prefix}), 8))::BIGINT % 1000)"


def _toks(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '\\s+'), lambda w: w <> '')"


# --- union and rows ---


def documents_as_rows(t) -> DataFrame:
    d = t.documents
    file = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".docx"))
    return D.text_rows(d, "document", F.col("text"), F.col("source"), file, F.concat("source", F.lit("/"), file))


def logs_as_rows(t) -> DataFrame:
    entries = L.sql_entries(L.sql_statements(rendered.order_scripts(t.orders)))
    return D.text_rows(entries, "log", F.col("raw_content"), F.lower("log_type"), F.col("source_file"))


_ROWS_SQL = f"""{ORDER_SQL},
rows AS (
  SELECT text, 'document' AS source, source AS category, 'doc_' || doc_id || '.docx' AS file,
    source || '/doc_' || doc_id || '.docx' AS path FROM documents UNION ALL
  SELECT raw_content, 'log', lower(log_type), source_file, NULL FROM statements)"""


@query("training_table", f"WITH {_ROWS_SQL} SELECT * FROM rows")
def _(t):
    return D.training_table(documents_as_rows(t), logs_as_rows(t)).select("text", "metadata.*")


@query(
    "log_instruction_rows",
    f"""WITH {ORDER_SQL} SELECT 'Write the ' || lower(log_type) || ' statement for ' || tables AS instruction, '' AS input,
      raw_content AS output, 'log' AS source, lower(log_type) AS category, source_file AS file FROM statements""",
)
def _(t):
    entries = L.sql_entries(L.sql_statements(rendered.order_scripts(t.orders)))
    instruction = F.concat(F.lit("Write the "), F.lower("log_type"), F.lit(" statement for "), F.array_join("tables", ","))
    return D.log_instructions(entries, instruction).select("instruction", "input", "output", "metadata.*")


@query(
    "category_by_folder",
    "SELECT page_id, url, CASE WHEN contains(rel, '/') THEN regexp_extract(rel, '^(.*)/[^/]*$', 1) ELSE '.' END AS category, "
    "regexp_extract(rel, '([^/]*)$', 1) AS file_name FROM (SELECT *, regexp_replace(url, '^https?://', '') AS rel FROM pages)",
)
def _(t):
    relative = F.regexp_replace("url", "^https?://", "")
    return t.pages.select(
        "page_id", "url", paths.category(relative).alias("category"), paths.file_name(relative).alias("file_name")
    )


@query(
    "category_lookup",
    "SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey) "
    "ON c_nationkey = n_nationkey",
)
def _(t):
    names = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name"
    )
    return D.with_category(t.customer, names, "c_nationkey").select("c_custkey", "n_name", "r_name")


@query(
    "path_parts",
    """SELECT doc_id, 'part_' || doc_id || '.v1.docx' AS file_name, 'part_' || doc_id || '.v1' AS stem, '.docx' AS suffix,
      source || '/' || lang || '/part_' || doc_id || '.v1.docx' AS relative_path, source || '/' || lang AS category FROM documents""",
)
def _(t):
    path = F.concat(F.lit("/data/in/"), "source", F.lit("/"), "lang", F.lit("/part_"), F.col("doc_id").cast("string"), F.lit(".v1.docx"))
    relative = paths.relative_path(F.col("path"), F.lit("/data/in/"))
    return t.documents.select("doc_id", path.alias("path")).select(
        "doc_id",
        paths.file_name(F.col("path")).alias("file_name"),
        paths.stem(F.col("path")).alias("stem"),
        paths.suffix(F.col("path")).alias("suffix"),
        relative.alias("relative_path"),
        paths.category(relative).alias("category"),
    )


# --- prompts and tokens ---


def instruction_rows(t) -> DataFrame:
    """user turn = instruction, the assistant turn after it = output, a system turn before it = input."""
    turns = t.conversations
    asked = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("instruction"))
    answered = turns.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output"))
    system = turns.where("role = 'system'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("input"))
    return asked.join(answered, ["conv_id", "turn"]).join(system, ["conv_id", "turn"], "left")


_INSTRUCTION_SQL = """rows AS (SELECT u.conv_id, u.turn, u.text AS instruction, a.text AS output, s.text AS input
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  LEFT JOIN conversations s ON s.conv_id = u.conv_id AND s.turn = u.turn - 1 AND s.role = 'system' WHERE u.role = 'user'),
prompts AS (SELECT *, '### Instruction:' || chr(10) || instruction || chr(10) || chr(10) || '### Input:' || chr(10) || coalesce(input, '')
  || chr(10) || chr(10) || '### Response:' || chr(10) || output AS text FROM rows)"""


@query("instruction_prompt", f"WITH {_INSTRUCTION_SQL} SELECT conv_id, turn, text FROM prompts")
def _(t):
    return D.with_prompt(instruction_rows(t)).select("conv_id", "turn", "text")


@query(
    "prompt_template",
    "SELECT event_id, '<' || event_type || '> ' || value || ' {' || user_id || '}' AS prompt FROM events",
)
def _(t):
    template = "<{event_type}> {value}{missing} {{{user_id}}}"
    return D.with_prompt(t.events, template, "prompt").select("event_id", "prompt")


@query(
    "prompt_tokens",
    f"WITH {_INSTRUCTION_SQL} SELECT conv_id, turn, array_to_string({_toks('text')}[:64], ' ') AS text, "
    f"least(len({_toks('text')}), 64)::BIGINT AS n_tokens FROM prompts",
)
def _(t):
    return D.tokenized(D.with_prompt(instruction_rows(t)), 64, keep=["conv_id", "turn"])


@query(
    "token_counts",
    f"SELECT doc_id, len({_toks('text')})::BIGINT AS n_tokens, n_chars FROM documents",
)
def _(t):
    return t.documents.select("doc_id", text.token_count(F.col("text")).cast("bigint").alias("n_tokens"), "n_chars")


@query(
    "strip_prompt",
    f"WITH {_INSTRUCTION_SQL} SELECT conv_id, turn, regexp_replace(output, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g') AS answer FROM prompts",
)
def _(t):
    rows = instruction_rows(t)
    generated = F.concat("instruction", F.lit(" \n"), "output", F.lit("  "))
    return rows.select("conv_id", "turn", text.strip_prompt(generated, F.col("instruction")).alias("answer"))


@query(
    "join_paragraphs",
    "SELECT doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT regexp_matches(x, '^[\\s\\p{Z}]*$')), "
    "chr(10) || chr(10)) AS full_text FROM documents",
)
def _(t):
    kept = F.filter(F.split("text", "\n"), lambda x: ~text.is_blank(x))
    return t.documents.select("doc_id", text.join_paragraphs(kept).alias("full_text"))


# --- filters ---


@query("minimum_length", "SELECT doc_id, n_chars FROM documents WHERE length(text) >= 50")
def _(t):
    return t.documents.where(F.length("text") >= 50).select("doc_id", "n_chars")


@query(
    "document_summary",
    """SELECT count(*) AS total, count(*) FILTER (length(text) >= 50) AS succeeded, count(*) FILTER (length(text) < 50) AS failed,
      round((100.0 * count(*) FILTER (length(text) >= 50) / count(*))::DOUBLE, 6) AS success_rate FROM documents""",
)
def _(t):
    from logloom.operators.documents import summary

    row = summary(t.documents.select((F.length("text") >= 50).alias("ok")))
    return row.withColumn("success_rate", F.round("success_rate", 6))


@query(
    "blank_line_removal",
    "SELECT doc_id, pos - 1 AS line_no, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, "
    "generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents) WHERE NOT regexp_matches(line, '^[\\s\\p{Z}]*$')",
)
def _(t):
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.where(~text.is_blank(F.col("line"))).withColumn("line_no", F.col("line_no").cast("bigint"))


@query("null_normalization", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS balance, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer")
def _(t):
    from logloom.sources.datasets import missing_to_null

    shown = t.customer.select(
        "c_custkey",
        F.when(F.col("c_acctbal") < 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal")).alias("balance"),
        F.when(F.col("c_mktsegment") == "BUILDING", "N/A").otherwise(F.col("c_mktsegment")).alias("segment"),
    )
    return missing_to_null(shown)


@query(
    "error_policy_counts",
    "SELECT count(*) FILTER (event_id % 97 > 0) AS kept, count(*) FILTER (event_id % 97 = 0) AS rejected FROM events",
)
def _(t):
    from logloom.operators.errors import apply_policy, rejected

    lines = rendered.event_lines(t.events).withColumn("ok", F.try_parse_json("line").isNotNull())
    kept = apply_policy(lines, F.col("ok"), "warn").agg(F.count("*").alias("kept"), F.lit(0).cast("bigint").alias("rejected"))
    bad = rejected(lines, F.col("ok")).agg(F.lit(0).cast("bigint").alias("kept"), F.count("*").alias("rejected"))
    return kept.unionByName(bad).agg(F.sum("kept").alias("kept"), F.sum("rejected").alias("rejected"))


# --- splits, caps, order, batches ---

_BUCKET = _digits("'42:' || doc_id")
_HASH32 = "('0x' || left(md5('42:' || doc_id), 8))::BIGINT"


@query(
    "train_val_test_split",
    f"SELECT doc_id, CASE WHEN {_BUCKET} < 800 THEN 'train' WHEN {_BUCKET} < 900 THEN 'val' ELSE 'test' END AS split FROM documents",
)
def _(t):
    return t.documents.select("doc_id", D.split_name(F.col("doc_id")).alias("split"))


@query(
    "split_small_share",
    f"SELECT doc_id, CASE WHEN {_BUCKET} * {D.FINE}::BIGINT + {_HASH32} // 1000 < round(0.9996 * 1000 * {D.FINE}) THEN 'train' ELSE 'val' END AS split FROM documents",
)
def _(t):
    """A share below a thousandth gets its rows too."""
    return t.documents.select("doc_id", D.split_name(F.col("doc_id"), {"train": 0.9996, "val": 0.0004}).alias("split"))


@query(
    "hold_out_split",
    f"SELECT doc_id, CASE WHEN {_digits(chr(39) + '7:' + chr(39) + ' || doc_id')} < 900 THEN 'train' ELSE 'validation' END AS split FROM documents",
)
def _(t):
    return t.documents.select("doc_id", D.hold_out(F.col("doc_id"), seed=7).alias("split"))


@query(
    "validation_fallback",
    "SELECT 'train' AS split, count(*) AS examples, sum(n_chars)::BIGINT AS chars FROM documents UNION ALL "
    "SELECT 'validation', count(*), sum(n_chars)::BIGINT FROM documents",
)
def _(t):
    rows = D.with_validation(t.documents.select("doc_id", "n_chars"))
    return rows.groupBy("split").agg(F.count("*").alias("examples"), F.sum("n_chars").alias("chars"))


@query("random_sample", "SELECT doc_id, lang FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 25")
def _(t):
    return D.random_rows(t.documents.select("doc_id", "lang"), 25, "doc_id")


@query("first_examples", "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 10")
def _(t):
    return D.first_rows(t.documents.select("doc_id", "text"), 10, ["doc_id"])


@query(
    "row_cap_large",
    "SELECT l_orderkey, count(*) AS n FROM (SELECT * FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) "
    "ORDER BY l_orderkey, l_linenumber LIMIT 20000) GROUP BY l_orderkey",
)
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber").distinct()
    kept = D.first_rows(rows, 20000, ["l_orderkey", "l_linenumber"])
    return kept.groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query(
    "row_cap_ties",
    "SELECT l_shipdate, count(*) AS n FROM (SELECT l_shipdate FROM lineitem ORDER BY l_shipdate NULLS FIRST LIMIT 5003) GROUP BY l_shipdate",
)
def _(t):
    """The last day of the cap has more rows than are left for it."""
    kept = D.first_rows(t.lineitem.select("l_shipdate", "l_orderkey"), 5003, ["l_shipdate"])
    return kept.groupBy("l_shipdate").agg(F.count("*").alias("n"))


@query(
    "shuffled_order",
    "SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS position FROM documents",
)
def _(t):
    return D.shuffle_position(t.documents.select("doc_id"), "doc_id")


@query(
    "micro_batches",
    "SELECT p_partkey, rn // 32 AS batch, rn % 32 // 5 AS micro_batch FROM (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS rn FROM part)",
)
def _(t):
    return D.micro_batches(t.part.select("p_partkey"), 32, 5, "p_partkey", chunk_of(F.col("p_partkey")))


@query(
    "micro_batches_sharded",
    "SELECT p_partkey, p_brand, rn // 16 AS batch, rn % 16 // 4 AS micro_batch FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS rn FROM part)",
)
def _(t):
    return D.micro_batches(t.part.select("p_partkey", "p_brand"), 16, 4, "p_partkey", chunk_of(F.col("p_partkey")), ["p_brand"])


# --- validation and statistics ---


@query(
    "column_pruning",
    "SELECT doc_id, lang FROM documents",
)
def _(t):
    return D.require_columns(t.documents, ["doc_id", "text"]).drop("text", "source", "n_chars")


@query(
    "required_fields",
    f"""WITH {_INSTRUCTION_SQL} SELECT conv_id, turn, field, problem FROM (
      SELECT conv_id, turn, 'input' AS field, CASE WHEN input IS NULL THEN 'null' WHEN trim(input) = '' THEN 'blank' END AS problem FROM rows UNION ALL
      SELECT conv_id, turn, 'output', CASE WHEN output IS NULL THEN 'null' WHEN trim(output) = '' THEN 'blank' END FROM rows)
    WHERE problem IS NOT NULL""",
)
def _(t):
    rows = instruction_rows(t).withColumn("id", F.struct("conv_id", "turn"))
    found = D.violations(rows, "id", ["input", "output"])
    return found.select("id.conv_id", "id.turn", "field", "problem")


@query(
    "length_flags",
    f"SELECT doc_id, CASE WHEN len({_toks('text')}) < 20 THEN 'short' WHEN len({_toks('text')}) > 400 THEN 'long' END AS flag FROM documents",
)
def _(t):
    counted = t.documents.withColumn("n", text.token_count(F.col("text")))
    return counted.select("doc_id", D.length_flag(F.col("n"), 20, 400).alias("flag"))


@query(
    "text_statistics",
    f"""SELECT source, lang, count(*) AS examples, sum(n)::BIGINT AS tokens, round(avg(n), 6) AS mean_tokens, min(n) AS min_tokens,
      quantile_cont(n, 0.25)::DOUBLE AS q1_tokens, quantile_cont(n, 0.5)::DOUBLE AS median_tokens, quantile_cont(n, 0.75)::DOUBLE AS q3_tokens,
      max(n) AS max_tokens FROM (SELECT *, len({_toks('text')})::BIGINT AS n FROM documents) GROUP BY ALL""",
)
def _(t):
    stats = D.text_statistics(t.wide("documents"), ["source", "lang"])
    return stats.withColumn("mean_tokens", F.round("mean_tokens", 6))


_NORM = "trim(regexp_replace(regexp_replace(lower(text), '[^\\p{L}\\p{N}_\\s'']', ' ', 'g'), '\\s+', ' ', 'g'))"


@query(
    "duplicate_flags",
    f"""SELECT doc_id, copies, kept, kept <> doc_id AS is_duplicate FROM (SELECT doc_id, count(*) OVER (PARTITION BY h) AS copies,
      min(doc_id) OVER (PARTITION BY h) AS kept FROM (SELECT doc_id, md5({_NORM}) AS h FROM documents))""",
)
def _(t):
    return D.duplicate_flags(t.wide("documents"), "doc_id")
