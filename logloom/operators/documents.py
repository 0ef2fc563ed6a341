"""Document tables: extraction from HTML, length gate, metadata, summary."""

from __future__ import annotations

from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.functions import paths
from logloom.functions.text import is_blank, strip

# Elements whose start or end closes an open paragraph.
BLOCKS = (
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead title tr ul"
).split()
# Named character references that are resolved.
ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0", "amp": "&"}
_OTHER_REFERENCE = (
    rf"&(?!(?:{'|'.join(ENTITIES)});)(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"
)

_START, _END = "\u0001", "\u0002"
TABLES = "array<array<array<string>>>"
IMAGES = T.ArrayType(
    T.StructType([T.StructField("alt_text", T.StringType()), T.StructField("index", T.IntegerType()), T.StructField("format", T.StringType())])
)


def visible_html(html: Column) -> Column:
    """HTML without comments, scripts and styles."""
    return F.regexp_replace(html, r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>", "")


def without_tags(html: Column) -> Column:
    return F.regexp_replace(html, r"<[^>]*>", "")


def plain_text(html: Column) -> Column:
    """Tags removed, common character references resolved (the ampersand last)."""
    return _resolved(without_tags(html))


def _resolved(text: Column) -> Column:
    for name, character in ENTITIES.items():
        text = F.replace(text, F.lit(f"&{name};"), F.lit(character))
    return text


@F.pandas_udf(T.ArrayType(T.StringType()))
def _resolved_all(texts: pd.Series) -> pd.Series:
    return texts.map(lambda xs: None if xs is None else [unescape(x) for x in xs])


def html_paragraphs(visible: Column) -> Column:
    """Texts of all ``<p>`` without tags; one ends at its end tag or at the next block element."""
    names = "|".join(b for b in BLOCKS)
    marked = F.regexp_replace(visible, r"(?i)<p(?:\s[^>]*)?>", _START)
    marked = F.regexp_replace(marked, rf"(?i)</?(?:{names})(?:\s[^>]*)?/?>", _END)
    pieces = F.regexp_extract_all(marked, F.lit(f"{_START}([^{_START}{_END}]*)"), F.lit(1))
    return F.transform(pieces, without_tags)


def resolved_paragraphs(raw: Column) -> Column:
    """Character references resolved and blank paragraphs dropped.

    Only rows with a reference outside the common few go to Python, the others
    send null.
    """
    rare = F.exists(raw, lambda x: x.rlike(_OTHER_REFERENCE))
    texts = F.coalesce(_resolved_all(F.when(rare, raw)), F.transform(raw, _resolved))
    return F.filter(texts, lambda x: ~is_blank(x))


def html_tables(visible: Column) -> Column:
    """Cells of all tables that hold no other table, as rows of trimmed texts."""
    tables = F.regexp_extract_all(visible, F.lit(r"(?is)<table\b[^>]*>(.*?)</table\s*>"), F.lit(1))

    def cells(row: Column) -> Column:
        found = F.regexp_extract_all(row, F.lit(r"(?is)<t[dh](?:\s[^>]*)?>(.*?)(?:</t[dh]\s*>|\z|(?=<t[dh][\s>]))"), F.lit(1))
        return F.transform(found, lambda c: strip(plain_text(c)))

    def rows(table: Column) -> Column:
        found = F.regexp_extract_all(table, F.lit(r"(?is)<tr(?:\s[^>]*)?>(.*?)(?:</tr\s*>|\z|(?=<tr[\s>]))"), F.lit(1))
        return F.transform(found, cells)

    return F.transform(tables, rows)


class _TableParser(HTMLParser):
    """Tables inside tables: a row belongs to every table around it, a cell to every open row."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables, self.open = [], []

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.tables.append([])
            self.open.append({"table": self.tables[-1], "row": None, "cell": None})
        elif tag == "tr" and self.open:
            row = []
            self.open[-1].update(row=row, cell=None)
            for level in self.open:
                level["table"].append(row)
        elif tag in ("td", "th") and self.open:
            cell = []
            self.open[-1]["cell"] = cell
            for level in self.open:
                if level["row"] is not None:
                    level["row"].append(cell)

    def handle_endtag(self, tag):
        if tag == "table" and self.open:
            self.open.pop()
        elif tag == "tr" and self.open:
            self.open[-1].update(row=None, cell=None)
        elif tag in ("td", "th") and self.open:
            self.open[-1]["cell"] = None

    def handle_data(self, data):
        for level in self.open:
            if level["cell"] is not None:
                level["cell"].append(data)


@F.pandas_udf(T.ArrayType(T.ArrayType(T.ArrayType(T.StringType()))))
def nested_tables(html: pd.Series) -> pd.Series:
    def one(text):
        if text is None:
            return None
        parser = _TableParser()
        parser.feed(text)
        return [[["".join(c).strip() for c in row] for row in table] for table in parser.tables]

    return html.map(one)


def html_images(visible: Column) -> Column:
    """``alt_text, index, format`` of every ``<img>`` in order."""
    tags = F.regexp_extract_all(visible, F.lit(r"(?i)<img\b[^>]*>"), F.lit(0))

    def image(tag: Column, i: Column) -> Column:
        double, single = (F.regexp_extract(tag, rf"(?i)\salt\s*=\s*{q}([^{q}]*){q}", 1) for q in "\"'")
        return F.struct(
            plain_text(F.when(double != "", double).otherwise(single)).alias("alt_text"),
            i.cast("int").alias("index"),
            F.lit("unknown").alias("format"),
        )

    return F.transform(tags, image)


def html_documents(
    pages: DataFrame,
    html: str = "html",
    separator: str = "\n\n",
    extract_tables: bool = True,
    extract_images: bool = False,
    include_raw_html: bool = False,
) -> DataFrame:
    """Adds ``paragraphs, tables, images, full_text`` (and ``raw_html``) to a table of pages."""
    keep = [c for c in pages.columns if c != html]
    df = pages.withColumn("__visible", visible_html(F.col(html)))
    df = df.withColumn("__raw", html_paragraphs(F.col("__visible")))
    df = df.withColumn("paragraphs", resolved_paragraphs(F.col("__raw")))
    tables = F.array().cast(TABLES)
    if extract_tables:
        # only pages with a table inside a table go to the parser, the others send null
        inner = F.col("__visible").rlike(r"(?is)<table\b(?:(?!</table).)*<table\b")
        nested = nested_tables(F.when(inner, F.col("__visible")))
        tables = F.coalesce(nested, html_tables(F.col("__visible")))
    images = html_images(F.col("__visible")) if extract_images else F.array().cast(IMAGES)
    out = [*keep, "paragraphs", tables.alias("tables"), images.alias("images"), F.array_join("paragraphs", separator).alias("full_text")]
    if include_raw_html:
        out.append(F.col(html).alias("raw_html"))
    return df.select(*out)


def long_enough(documents: DataFrame, min_text_length: int = 50) -> DataFrame:
    return documents.where(F.length("full_text") >= min_text_length)


def with_metadata(documents: DataFrame, root: str, preserve_structure: bool = True, path: str = "path") -> DataFrame:
    """Adds ``metadata{filename, path, relative_path, category, file_type, extraction_method}``."""
    relative = paths.relative_path(F.col(path), F.lit(root))
    return documents.withColumn(
        "metadata",
        F.struct(
            paths.file_name(F.col(path)).alias("filename"),
            F.col(path).alias("path"),
            relative.alias("relative_path"),
            (paths.category(relative) if preserve_structure else F.lit("")).alias("category"),
            F.ltrim(F.lower(paths.suffix(F.col(path))), F.lit(".")).alias("file_type"),
            F.col("extraction_method"),
        ),
    )


def summary(outcomes: DataFrame, ok: str = "ok") -> DataFrame:
    """``total, succeeded, failed, success_rate`` in percent."""
    return outcomes.agg(
        F.count("*").alias("total"),
        F.count_if(F.col(ok)).alias("succeeded"),
        F.count_if(~F.coalesce(F.col(ok), F.lit(False))).alias("failed"),
        (100.0 * F.count_if(F.col(ok)) / F.count("*")).alias("success_rate"),
    )
