"""Outputs: log entries, statistics, documents, images, datasets, examples, scores, run logs, report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.operators.log_entries import entry_json
from logloom.session import stage
from logloom.sinks.catalogue import clustered

DATASET_FORMATS = {"jsonl": "json", "json": "json", "csv": "csv", "parquet": "parquet"}


def write_entries(envelopes: DataFrame, path: str, mode: str = "errorifexists", file_bytes: int | None = None) -> None:
    """One JSON object per line under ``source_format=/source_file=``.

    The file name keeps its suffix, so ``a.sql`` and ``a.csv`` do not overwrite
    each other. One huge source file is still written by many tasks. Without
    ``file_bytes`` nothing is moved and each task writes a file per source file it
    holds; with it the entries are written once more and dealt so that a source
    file has about as many files as its bytes need.
    """
    entries = entry_json(envelopes)
    if file_bytes:
        keys, size = ["source_format", "source_file"], F.octet_length("value") + 1
        entries = clustered(stage(entries, "entries-to-cluster"), keys, size, file_bytes)
    entries.write.mode(mode).partitionBy("source_format", "source_file").text(path)


def write_stats(stats: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A one-row table as one JSON file."""
    stats.coalesce(1).write.mode(mode).json(path)


def write_documents(documents: DataFrame, path: str, fmt: str = "json", by_category: bool = True, mode: str = "errorifexists") -> None:
    """``json`` / ``jsonl`` objects or ``plain_text``; the folder tree is kept as ``category=``."""
    fmt = fmt.lower()
    category = F.col("metadata.category") if "metadata" in documents.columns else F.lit("")
    if fmt in ("json", "jsonl"):
        shown = documents
        if "images" in documents.columns and "data" in _fields(documents, "images"):
            shown = documents.withColumn("images", F.transform("images", _base64_image))
        value = F.to_json(F.struct(*[F.col(c) for c in shown.columns]), {"ignoreNullFields": "false"})
    elif fmt == "plain_text":
        shown, value = documents, F.col("full_text")
    else:
        raise ValueError(f"unsupported output format: {fmt}")
    out = shown.select(category.alias("category"), value.alias("value")) if by_category else shown.select(value.alias("value"))
    writer = out.write.mode(mode)
    (writer.partitionBy("category") if by_category else writer).text(path)


def _fields(df: DataFrame, name: str) -> list[str]:
    return df.schema[name].dataType.elementType.fieldNames()


def _base64_image(image):
    return image.withField("data", F.base64(image["data"])).withField(
        "encoding", F.when(image["data"].isNotNull(), "base64")
    )


def image_table(documents: DataFrame, key: str = "path") -> DataFrame:
    """``key, filename, content_type, data``: equal names of different documents stay apart."""
    return documents.select(key, F.inline("images")).where("filename is not null").select(key, "filename", "content_type", "data")


def write_dataset(rows: DataFrame, path: str, fmt: str = "jsonl", mode: str = "errorifexists") -> None:
    """Rows by ``split``; csv holds nested columns as JSON text."""
    if fmt not in DATASET_FORMATS:
        raise ValueError(f"unsupported dataset format: {fmt}")
    if fmt == "csv":
        nested = [f.name for f in rows.schema if f.dataType.typeName() in ("struct", "array", "map")]
        rows = rows.withColumns({c: F.to_json(c) for c in nested})
    writer = rows.write.mode(mode).format(DATASET_FORMATS[fmt])
    if "split" in rows.columns:
        writer = writer.partitionBy("split")
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"').option("quoteAll", True)
    writer.save(path)


def write_examples(examples: DataFrame, path: str, mode: str = "errorifexists") -> None:
    examples.write.mode(mode).json(path)


def write_scores(scores: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``metric, sub_metric, value`` as one CSV folder per metric; scores are a handful of rows."""
    scores.coalesce(1).write.mode(mode).partitionBy("metric").option("header", True).csv(path)


def append_run(table: DataFrame, path: str, run: str = "run") -> None:
    """Add a run's samples, checkpoints or trials to its catalogue; the run is a column, sorted in every file (no folder per run)."""
    table.sortWithinPartitions(run).write.mode("append").parquet(path)


def serializable(df: DataFrame) -> DataFrame:
    """Integers as bigint, floats and decimals as double, nested values as JSON text."""
    wide = {"byte": "bigint", "short": "bigint", "integer": "bigint", "float": "double", "decimal": "double"}
    columns = {}
    for f in df.schema:
        kind = f.dataType.typeName()
        if kind in wide:
            columns[f.name] = F.col(f.name).cast(wide[kind])
        elif kind in ("struct", "array", "map", "variant"):
            columns[f.name] = F.to_json(f.name)
    return df.withColumns(columns)


# --- report ---

# The headings and labels of the report.
TITLE = "# Model Evaluation Report"
SUMMARY = "## Metrics Summary"
EXAMPLES = "## Generation Examples"
ROUGE_TABLE = ["### ROUGE Scores", "", "| Metric | Precision | Recall | F1 |", "|--------|-----------|--------|----|"]
SECTIONS = [
    ("perplexity", "### Perplexity", {"perplexity": "Perplexity", "avg_loss": "Average Loss", "total_tokens": "Total Tokens"}),
    ("rouge", None, {}),
    ("bleu", "### BLEU Score", {"bleu": "BLEU"}),
    ("exact_match", "### Exact Match", {None: "Score"}),
    ("accuracy", "### Accuracy", {None: "Score"}),
    ("f1", "### F1 Score", {"f1": "F1", "precision": "Precision", "recall": "Recall"}),
]
PRECISIONS = "- **N-gram Precisions:**"
DOMAIN = "### Domain-Specific Metrics"
EXAMPLE_FIELDS = {"prompt": "Prompt", "reference": "Reference", "prediction": "Prediction"}


def _number(sub: str | None, value: float) -> str:
    return f"{value:.0f}" if sub == "total_tokens" else f"{value:.4f}"


def render_report(
    scores: DataFrame, model: str, examples: DataFrame | None = None, now: dt.datetime | None = None, n_examples: int = 5
) -> str:
    """Markdown of a scores table (a few dozen rows) and of at most ``n_examples`` examples."""
    values = {(r.metric, r.sub_metric): r.value for r in scores.collect() if r.value is not None}
    stamp = (now or dt.datetime.now()).strftime("%Y-%m-%d %H:%M:%S")
    blocks = [[TITLE, "", f"**Model:** {model}", f"**Date:** {stamp}"], [SUMMARY]]
    rouge = sorted({m for m, _ in values if m.startswith("rouge")})
    orders = [(n, values["bleu", f"precision_{n}"]) for n in range(1, 5) if ("bleu", f"precision_{n}") in values]
    for metric, heading, labels in SECTIONS:
        if metric == "rouge" and rouge:
            cells = [[m] + [_number(p, values[m, p]) for p in ("precision", "recall", "fmeasure")] for m in rouge]
            blocks.append(ROUGE_TABLE + ["| " + " | ".join(row) + " |" for row in cells])
        items = [f"- **{label}:** {_number(s, values[metric, s])}" for s, label in labels.items() if (metric, s) in values]
        if metric == "bleu" and orders:
            items += [PRECISIONS, *[f"  - {n}-gram: {p:.4f}" for n, p in orders]]
        if items:
            blocks.append([heading, "", *items])
    domain = sorted((s, v) for (m, s), v in values.items() if m == "domain")
    if domain:
        blocks.append([DOMAIN, "", *[f"- **{s}:** {_number(s, v)}" for s, v in domain]])
    if examples is not None:
        blocks.append([EXAMPLES])
        for i, row in enumerate(examples.select(*EXAMPLE_FIELDS).limit(n_examples).collect(), 1):
            shown = [line for c, label in EXAMPLE_FIELDS.items() for line in (f"**{label}:**", "```", str(row[c]), "```", "")]
            blocks.append([f"### Example {i}", "", *shown, "---"])
    return "\n\n".join("\n".join(block) for block in blocks) + "\n"


def write_report(scores: DataFrame, folder: str, model: str, examples: DataFrame | None = None, now: dt.datetime | None = None) -> str:
    """Scores and report under ``{model}_{time}``; returns that folder."""
    now = now or dt.datetime.now()
    spark = scores.sparkSession
    target = f"{folder}/{model.rstrip('/').rsplit('/', 1)[-1]}_{now.strftime('%Y%m%d_%H%M%S')}"
    write_stats(scores, f"{target}/evaluation_results")
    text = render_report(scores, model, examples, now)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{target}/evaluation_report")
    return target
