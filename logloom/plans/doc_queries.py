"""Document scans, sinks and the streaming ingest over the given tables."""

from __future__ import annotations

import datetime as dt
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.functions.timeparse import iso_text
from logloom.operators import documents as H
from logloom.operators import evaluation, runs
from logloom.operators import log_entries as L
from logloom.operators.dataset import first_rows, split_name
from logloom.operators.log_reports import processing_stats
from logloom.plans import rendered
from logloom.plans.dataset_queries import _BUCKET, documents_as_rows
from logloom.plans.metric_queries import EDITED_SQL, LOSS_SQL, batch_losses, edited_pairs, model_scores
from logloom.plans.registry import query
from logloom.plans.rendered import EVENT_SQL
from logloom.session import new_path, stage
from logloom.sinks import catalogue
from logloom.sinks import writers as K
from logloom.sinks.images import read_images, write_images
from logloom.sources import datasets, documents
from logloom.streaming import log_stream

_BLOCKS = "|".join(H.BLOCKS)


def _plain(x: str) -> str:
    x = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    for name, character in H.ENTITIES.items():
        quoted = character.replace("'", "''")
        x = f"replace({x}, '&{name};', '{quoted}')"
    return x


_PAGES_SQL = f"""visible AS (SELECT page_id, url, regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', '', 'g') AS v FROM pages),
marked AS (SELECT *, regexp_replace(regexp_replace(v, '(?i)<p(?:\\s[^>]*)?>', chr(1), 'g'), '(?i)</?(?:{_BLOCKS})(?:\\s[^>]*)?/?>', chr(2), 'g') AS m FROM visible),
texts AS (SELECT page_id, url, list_filter(list_transform(regexp_extract_all(m, chr(1) || '([^' || chr(1) || chr(2) || ']*)', 1),
  lambda x: {_plain('x')}), lambda x: NOT regexp_matches(x, '^[\\s\\p{{Z}}]*$')) AS paragraphs FROM marked)"""


@query(
    "html_paragraphs",
    f"WITH {_PAGES_SQL} SELECT page_id, len(paragraphs)::BIGINT AS paragraph_count, array_to_string(paragraphs, chr(10) || chr(10)) AS full_text FROM texts",
)
def _(t):
    docs = H.html_documents(t.wide("pages"))
    return docs.select("page_id", F.size("paragraphs").cast("bigint").alias("paragraph_count"), "full_text")


@query(
    "html_minimum_length",
    f"WITH {_PAGES_SQL} SELECT page_id FROM texts WHERE length(array_to_string(paragraphs, chr(10) || chr(10))) >= 1500",
)
def _(t):
    return H.long_enough(H.html_documents(t.wide("pages"), extract_tables=False), 1500).select("page_id")


def order_pages(t) -> DataFrame:
    """One page per customer with a table of the orders and a picture."""
    o = t.orders
    row = F.concat(F.lit("<tr><td> "), F.col("o_orderkey").cast("string"), F.lit(" </td><td><b>"), F.col("o_orderstatus"), F.lit("</b> &amp; "), F.col("o_orderpriority"), F.lit("</td></tr>"))
    rows = o.groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", row.alias("row")))).alias("rows"))
    html = F.concat(
        F.lit("<html><body><p>Orders of "), F.col("o_custkey").cast("string"),
        F.lit("<table class='x'><tr><th>key</th><th>state</th></tr>"), F.array_join(F.transform("rows", lambda r: r["row"]), "\n"),
        F.lit("</table><img src='a.png' alt=\"customer "), F.col("o_custkey").cast("string"), F.lit("\"><img src='b.png'></body></html>"),
    )
    return rows.select("o_custkey", html.alias("html"))


@query(
    "html_tables",
    """SELECT o_custkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey))::BIGINT AS row_no,
      o_orderkey::VARCHAR || '|' || o_orderstatus || ' & ' || o_orderpriority AS cells FROM orders
    UNION ALL SELECT DISTINCT o_custkey, 0, 'key|state' FROM orders""",
)
def _(t):
    docs = H.html_documents(order_pages(t))
    rows = docs.select("o_custkey", F.explode("tables").alias("table")).select("o_custkey", F.posexplode("table").alias("row_no", "row"))
    return rows.select("o_custkey", F.col("row_no").cast("bigint").alias("row_no"), F.array_join("row", "|").alias("cells"))


@query(
    "html_images",
    "SELECT DISTINCT o_custkey, i AS image_no, CASE i WHEN 0 THEN 'customer ' || o_custkey ELSE '' END AS alt_text, 'unknown' AS format "
    "FROM orders, (SELECT unnest([0::BIGINT, 1::BIGINT]) AS i)",
)
def _(t):
    docs = H.html_documents(order_pages(t), extract_images=True)
    return docs.select("o_custkey", F.inline("images")).select(
        "o_custkey", F.col("index").cast("bigint").alias("image_no"), "alt_text", "format"
    )


# --- Word packages written from documents ---

_NS = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


_KIND = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PICTURE_RELATION = '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(
    f'<Relationship Id="r{n}" Type="{_KIND}/{kind}" Target="{target}"/>'
    for n, (kind, target) in enumerate([("image", "media/image1.png"), ("header", "header1.xml"), ("footer", "footer1.xml")], 1)
) + "</Relationships>"
_SECTION = f'<w:sectPr xmlns:r="{_KIND}"><w:headerReference w:type="default" r:id="r2"/><w:footerReference w:type="default" r:id="r3"/></w:sectPr>'


@F.pandas_udf(T.BinaryType())
def word_package(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """A minimal package: one paragraph per line, a two-cell table, a title; broken where the text is null."""

    def escape(x):
        x = "".join(c for c in x if c in "\t\n" or ord(c) >= 32)
        return x.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")

    def one(text, title):
        if text is None:
            return b"PK\x03\x04 broken"
        cell = '<w:tc><w:p><w:r><w:t xml:space="preserve"> {} </w:t></w:r></w:p></w:tc>'
        lines = "".join(f'<w:p><w:r><w:t xml:space="preserve">{escape(x)}</w:t></w:r></w:p>' for x in text.split("\n"))
        table = f"<w:tbl><w:tr>{cell.format('title')}{cell.format(escape(title))}</w:tr></w:tbl>"
        body = f"<w:document {_NS}><w:body>{lines}{table}{_SECTION}</w:body></w:document>"
        core = (
            '<cp:coreProperties xmlns:cp="http://schemas.openxmlformats.org/package/2006/metadata/core-properties" '
            f'xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:title>{escape(title)}</dc:title></cp:coreProperties>'
        )
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("word/document.xml", body)
            z.writestr("docProps/core.xml", core)
            z.writestr("word/_rels/document.xml.rels", _PICTURE_RELATION)
            z.writestr("word/header1.xml", f'<w:hdr {_NS}><w:p><w:r><w:t>Collection {escape(title)}</w:t></w:r></w:p><w:p/></w:hdr>')
            z.writestr("word/footer1.xml", f'<w:ftr {_NS}><w:p><w:r><w:t>End of {escape(title)}</w:t></w:r></w:p></w:ftr>')
            z.writestr("word/media/image1.png", f"picture of {title}".encode())
        return out.getvalue()

    # packages leave the worker slice by slice
    for texts, titles in batches:
        for at in range(0, len(texts), documents.SLICE):
            some = slice(at, at + documents.SLICE)
            yield pd.Series([one(x, y) for x, y in zip(texts.iloc[some], titles.iloc[some])], dtype=object)


def word_files(t) -> DataFrame:
    """One Word file per document; every 50th is a damaged package and every 50th after 25 is HTML."""
    d = t.wide("documents")
    k = F.col("doc_id") % 50
    html = F.concat(F.lit("<html><p>"), F.replace(F.replace("source", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("</p></html>"))
    package = word_package(F.when(k != 0, F.col("text")), F.col("source"))
    return d.select(
        F.concat(F.lit("/in/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.when(k == 25, ".doc").otherwise(".docx")).alias("path"),
        "doc_id",
        F.when(k == 25, F.encode(html, "utf-8")).otherwise(package).alias("content"),
    )


_WORD_LINES = "list_filter(string_split(text, chr(10)), lambda x: NOT regexp_matches(x, '^[\\s\\p{Z}]*$'))"


@query(
    "word_documents",
    f"""SELECT doc_id, CASE doc_id % 50 WHEN 0 THEN NULL WHEN 25 THEN 'html' ELSE 'docx' END AS extraction_method,
      CASE WHEN doc_id % 50 NOT IN (0, 25) THEN source END AS title,
      CASE WHEN doc_id % 50 NOT IN (0, 25) THEN 'title|' || source ELSE '' END AS cells,
      CASE doc_id % 50 WHEN 0 THEN NULL WHEN 25 THEN source ELSE array_to_string({_WORD_LINES}, chr(10) || chr(10)) END AS full_text
    FROM documents""",
)
def _(t):
    docs = documents.extract_documents(word_files(t))
    return docs.select(
        "doc_id",
        "extraction_method",
        F.col("properties")["title"].alias("title"),
        F.coalesce(F.array_join(F.flatten(F.flatten("tables")), "|"), F.lit("")).alias("cells"),
        F.when(F.col("extraction_method").isNotNull(), F.col("full_text")).alias("full_text"),
    )


@query(
    "word_headers_footers",
    """SELECT doc_id, 'Collection ' || source AS headers, 'End of ' || source AS footers FROM documents WHERE doc_id % 50 NOT IN (0, 25)
    UNION ALL SELECT doc_id, '', '' FROM documents WHERE doc_id % 50 IN (0, 25)""",
)
def _(t):
    """Damaged and HTML files have neither."""
    docs = documents.extract_documents(word_files(t), extract_tables=False, extract_metadata=False)
    return docs.select("doc_id", F.array_join("headers", "|").alias("headers"), F.array_join("footers", "|").alias("footers"))


@query(
    "find_documents_capped",
    """WITH files AS (SELECT 'part=' || lpad((page_id % 23)::VARCHAR, 2, '0') AS file, page_id FROM pages)
    SELECT * FROM files WHERE file IN (SELECT DISTINCT file FROM files ORDER BY file LIMIT 7)""",
)
def _(t):
    """A folder of HTML files named .doc; the first seven by path are opened."""
    path = new_path(t.spark, "doc-files")
    page = F.concat(F.lit("<p>"), F.col("page_id").cast("string"), F.lit("</p>"))
    part = F.lpad((F.col("page_id") % 23).cast("string"), 2, "0")
    rows = t.pages.select(page.alias("page"), part.alias("part")).repartition("part")
    rows.write.partitionBy("part").option("extension", "doc").csv(path)
    docs = documents.process_documents(t.spark, path, min_text_length=0, max_documents=7)
    return docs.select(
        F.regexp_extract("path", "(part=[0-9]+)/[^/]*$", 1).alias("file"), F.explode("paragraphs").alias("page")
    ).select("file", F.col("page").cast("bigint").alias("page_id"))


@query(
    "word_run_summary",
    f"""SELECT count(*) AS total, count(*) FILTER (ok) AS succeeded, count(*) FILTER (NOT ok) AS failed,
      round((100.0 * count(*) FILTER (ok) / count(*))::DOUBLE, 6) AS success_rate FROM (SELECT CASE doc_id % 50 WHEN 0 THEN false WHEN 25 THEN length(source) >= 50
      ELSE length(array_to_string({_WORD_LINES}, chr(10) || chr(10))) >= 50 END AS ok FROM documents)""",
)
def _(t):
    docs = documents.extract_documents(word_files(t), extract_tables=False, extract_metadata=False)
    ok = F.col("error").isNull() & (F.length("full_text") >= 50)
    return H.summary(docs.select(F.coalesce(ok, F.lit(False)).alias("ok"))).withColumn("success_rate", F.round("success_rate", 6))


@query(
    "document_metadata",
    """SELECT doc_id, doc_id || CASE doc_id % 50 WHEN 25 THEN '.doc' ELSE '.docx' END AS filename, source AS category,
      CASE doc_id % 50 WHEN 25 THEN 'doc' ELSE 'docx' END AS file_type FROM documents""",
)
def _(t):
    docs = word_files(t).drop("content").withColumn("extraction_method", F.lit("docx"))
    return H.with_metadata(docs, "/in").select("doc_id", "metadata.filename", "metadata.category", "metadata.file_type")


@query(
    "document_images",
    "SELECT doc_id, 'image1.png' AS filename, base64(encode('picture of ' || source)) AS data FROM documents WHERE doc_id % 50 NOT IN (0, 25)",
)
def _(t):
    # damaged and HTML files have no pictures
    docs = documents.extract_documents(word_files(t), extract_tables=False, extract_images=True)
    return K.image_table(docs, "doc_id").select("doc_id", "filename", F.base64("data").alias("data"))


@query(
    "image_files",
    """SELECT doc_id, 'image1.png' AS filename, 'files/' || left(h, 2) || '/' || h || '.png' AS file, base64(encode(picture)) AS data
    FROM (SELECT doc_id, 'picture of ' || source AS picture, sha256('picture of ' || source) AS h FROM documents WHERE doc_id % 50 NOT IN (0, 25))""",
)
def _(t):
    """Every picture written as a file and read back through the index."""
    path = new_path(t.spark, "image-files")
    write_images(documents.extract_documents(word_files(t), extract_tables=False, extract_images=True), path, "doc_id")
    return read_images(t.spark, path).select("doc_id", "filename", "file", F.base64("data").alias("data"))


# --- sinks, read back ---


@query(
    "stats_sink",
    f"WITH {EVENT_SQL} SELECT count(DISTINCT source_file) AS total_files, count(*) AS total_entries, count(*) AS entries_json FROM entries",
)
def _(t):
    path = new_path(t.spark, "stats")
    lines = rendered.event_lines(t.wide("events"))
    files = lines.select("source_file").distinct()
    K.write_stats(processing_stats(files, L.json_entries(lines, rows=t.events.count()).select("source_file", "source_format")), path)
    back = t.spark.read.schema("total_files bigint, total_entries bigint, entries_by_format map<string,bigint>").json(path)
    return back.select("total_files", "total_entries", F.col("entries_by_format")["json"].alias("entries_json"))


@query(
    "entry_sink",
    f"WITH {EVENT_SQL} SELECT source_file, log_type, count(*) AS entries, sum(entry_index)::BIGINT AS index_sum FROM entries GROUP BY ALL",
)
def _(t):
    path = new_path(t.spark, "entries")
    K.write_entries(L.to_log_entry(L.json_entries(rendered.event_lines(t.wide("events")), rows=t.events.count()), "json"), path)
    back = t.spark.read.text(path)
    parsed = back.withColumn("v", F.parse_json("value"))
    return parsed.groupBy("source_file", F.variant_get("v", "$.log_type", "string").alias("log_type")).agg(
        F.count("*").alias("entries"), F.sum(F.variant_get("v", "$.processing_info.index", "bigint")).alias("index_sum")
    )


@query(
    "entry_sink_files",
    f"WITH {EVENT_SQL} SELECT source_file, count(*) AS entries, sum(entry_index)::BIGINT AS index_sum, true AS files_fit FROM entries GROUP BY ALL",
)
def _(t):
    """Entries of each source file in as many files as its bytes need: no more than that, and no task writes one of its own."""
    path, file_bytes = new_path(t.spark, "entry-files"), 1 << 20
    envelopes = L.to_log_entry(L.json_entries(rendered.event_lines(t.wide("events")), rows=t.events.count()), "json")
    K.write_entries(envelopes, path, file_bytes=file_bytes)
    back = t.spark.read.text(path).select("source_file", "value", F.col("_metadata.file_path").alias("file"))
    index = F.get_json_object("value", "$.processing_info.index").cast("bigint")
    # one row per file first, so no distinct count moves the names of all entries
    files = back.groupBy("source_file", "file").agg(F.count("*").alias("n"), F.sum(index).alias("s"), F.sum(F.octet_length("value") + 1).alias("b"))
    return files.groupBy("source_file").agg(
        F.sum("n").alias("entries"), F.sum("s").alias("index_sum"), (F.count("*") <= F.ceil(F.sum("b") / file_bytes)).alias("files_fit")
    )


for _fmt in ("jsonl", "csv", "parquet"):

    @query(
        f"dataset_sink_{_fmt}",
        f"SELECT CASE WHEN {_BUCKET} < 800 THEN 'train' WHEN {_BUCKET} < 900 THEN 'val' ELSE 'test' END AS split, source AS category, "
        "count(*) AS examples, sum(length(text))::BIGINT AS chars FROM documents GROUP BY ALL",
    )
    def _(t, fmt=_fmt):
        path = new_path(t.spark, "dataset") + f".{fmt}"
        key = F.regexp_extract("metadata.file", r"(\d+)", 1).cast("bigint")
        K.write_dataset(documents_as_rows(t).withColumn("split", split_name(key)), path, fmt)
        schema = "text string, metadata string, split string" if fmt == "csv" else None
        back = datasets.load_dataset(t.spark, path, ["text", "metadata", "split"], schema)
        category = F.get_json_object("metadata", "$.category") if fmt == "csv" else F.col("metadata.category")
        return back.groupBy("split", category.alias("category")).agg(
            F.count("*").alias("examples"), F.sum(F.length("text")).alias("chars")
        )


@query(
    "document_sink",
    "SELECT source AS category, count(*) AS documents, sum(length(text))::BIGINT AS chars FROM documents GROUP BY source",
)
def _(t):
    path = new_path(t.spark, "documents")
    docs = t.documents.select(F.struct(F.col("source").alias("category")).alias("metadata"), F.col("text").alias("full_text"))
    K.write_documents(docs, path, "jsonl")
    back = t.spark.read.text(path)
    return back.groupBy("category").agg(
        F.count("*").alias("documents"), F.sum(F.length(F.get_json_object("value", "$.full_text"))).alias("chars")
    )


@query(
    "examples_sink",
    f"WITH {EDITED_SQL} SELECT count(*) AS examples, count(*) FILTER (prediction = reference) AS exact, sum(length(prediction))::BIGINT AS chars FROM pairs",
)
def _(t):
    from logloom.operators.pairs import example_metrics

    path = new_path(t.spark, "examples")
    K.write_examples(example_metrics(edited_pairs(t)), path)
    back = datasets.load_dataset(t.spark, path, ["prediction"], "prediction string, metrics map<string,double>")
    return back.agg(
        F.count("*").alias("examples"), F.count_if(F.col("metrics")["exact_match"] == 1).alias("exact"), F.sum(F.length("prediction")).alias("chars")
    )


@query(
    "scores_sink",
    f"WITH {LOSS_SQL} SELECT 'perplexity' AS metric, 'perplexity' AS sub_metric, round(exp(avg(loss)), 6) AS value FROM losses UNION ALL "
    "SELECT 'perplexity', 'avg_loss', round(avg(loss), 6) FROM losses UNION ALL SELECT 'perplexity', 'total_tokens', sum(n_tokens)::DOUBLE FROM losses",
)
def _(t):
    path = new_path(t.spark, "scores")
    K.write_scores(evaluation.perplexity_score(batch_losses(t)), path)
    back = t.spark.read.option("header", True).schema("sub_metric string, value double, metric string").csv(path)
    return back.select("metric", "sub_metric", F.round("value", 6).alias("value"))


@query("run_catalogue", "SELECT user_id AS run, count(*) AS samples, max(value) AS peak FROM events GROUP BY user_id")
def _(t):
    path = new_path(t.spark, "runs")
    samples = t.events.select(F.col("user_id").alias("run"), "event_id", "value")
    K.append_run(samples.repartition("run"), path)
    back = t.spark.read.schema("event_id bigint, value double, run bigint").parquet(path)
    return runs.telemetry_summary(back, ["event_id"]).select("run", F.col("tracked_steps").alias("samples"), F.col("peak_value").alias("peak"))


@query(
    "catalogue_rerun",
    """SELECT 'samples' AS kind, user_id AS run, count(*) AS n_rows, max(value) AS peak FROM events GROUP BY user_id
    UNION ALL SELECT 'checkpoints', user_id, count(*), max(peak) FROM (SELECT user_id, date_trunc('day', ts) AS d, max(value) AS peak FROM events GROUP BY ALL) GROUP BY user_id""",
)
def _(t):
    """Two kinds of run tables; one commit is made twice, one attempt stops before it is published."""
    path = new_path(t.spark, "catalogue")
    samples = t.events.select(F.col("user_id").alias("run"), "event_id", "value")
    samples = catalogue.clustered(stage(samples, "samples"), ["run"], F.lit(24))
    for _ in range(2):
        catalogue.commit_run(samples, path, "samples", "first")
    checkpoints = t.events.groupBy(F.col("user_id").alias("run"), F.date_trunc("day", "ts").alias("day")).agg(F.max("value").alias("value"))
    catalogue.write_attempt(checkpoints, path, "checkpoints")
    catalogue.commit_run(checkpoints, path, "checkpoints", "first")
    kinds = [catalogue.read_kind(t.spark, path, k).select(F.lit(k).alias("kind"), F.col("run").cast("bigint").alias("run"), "value") for k in ("samples", "checkpoints")]
    return kinds[0].unionByName(kinds[1]).groupBy("kind", "run").agg(F.count("*").alias("n_rows"), F.max("value").alias("peak"))


@query(
    "serializable_casts",
    "SELECT c_custkey, c_nationkey::BIGINT AS c_nationkey, '{\"name\":\"' || c_name || '\"}' AS info FROM customer",
)
def _(t):
    return K.serializable(t.customer.select("c_custkey", "c_nationkey", F.struct(F.col("c_name").alias("name")).alias("info")))


@query("evaluation_report")
def _(t):
    # the mean over all models, at a fixed time
    chosen = model_scores(t).groupBy("metric", "sub_metric").agg(F.avg("value").alias("value"))
    path = K.write_report(
        chosen.unionByName(evaluation.perplexity_score(batch_losses(t))), new_path(t.spark, "report"), "models/base",
        first_rows(edited_pairs(t).withColumn("prompt", F.col("prediction")), 3, ["example_id"]),
        dt.datetime(2024, 1, 1),
    )
    return t.spark.read.text(f"{path}/evaluation_report")


# --- streaming ingest ---


@query(
    "stream_entries",
    f"WITH {EVENT_SQL} SELECT log_type, count(*) AS entries, count(\"timestamp\") AS dated, sum(field_count)::BIGINT AS fields FROM entries GROUP BY ALL",
)
def _(t):
    source, out, state = (new_path(t.spark, x) for x in ("stream-in", "stream-out", "stream-state"))
    rendered.event_lines(t.wide("events")).select("line").write.text(source)
    log_stream.run_to_end(log_stream.stream_entries(log_stream.stream_lines(t.spark, source)), out, state)
    back = t.spark.read.parquet(out)
    return back.groupBy("log_type").agg(
        F.count("*").alias("entries"), F.count("timestamp").alias("dated"), F.sum("field_count").alias("fields")
    )


@query(
    "stream_window_counts",
    "SELECT date_trunc('hour', ts) AS window_start, event_type AS log_type, count(*) AS entries FROM events GROUP BY ALL",
)
def _(t):
    source, out, state = (new_path(t.spark, x) for x in ("stream-in", "stream-out", "stream-state"))
    line = F.to_json(F.struct(F.col("event_type").alias("type"), iso_text(F.col("ts")).alias("time")))
    t.events.select(line.alias("value")).write.text(source)
    counts = log_stream.windowed_counts(log_stream.stream_entries(log_stream.stream_lines(t.spark, source)))
    log_stream.run_windows_to_end(counts, out, state)
    return log_stream.last_windows(t.spark, out)
