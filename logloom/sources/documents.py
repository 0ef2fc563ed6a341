"""Word documents: discovery, extraction with a fallback, failures kept apart."""

from __future__ import annotations

import io
import posixpath
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.operators.dataset import cap_bound
from logloom.operators.documents import html_documents

EXTENSIONS = (".docx", ".doc")

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_REL = "{http://schemas.openxmlformats.org/package/2006/relationships}"
_TYPES = "{http://schemas.openxmlformats.org/package/2006/content-types}"
# The core properties that are read.
PROPERTIES = {
    "title": "{http://purl.org/dc/elements/1.1/}title",
    "author": "{http://purl.org/dc/elements/1.1/}creator",
    "created": "{http://purl.org/dc/terms/}created",
    "modified": "{http://purl.org/dc/terms/}modified",
    "last_modified_by": "{http://schemas.openxmlformats.org/package/2006/metadata/core-properties}lastModifiedBy",
}
DOCX_FIELDS = (
    "paragraphs array<string>, tables array<array<array<string>>>, "
    "images array<struct<filename:string,content_type:string,data:binary>>, "
    "headers array<string>, footers array<string>, properties map<string,string>, error string"
)


def find_documents(
    spark: SparkSession, path: str, recursive: bool = True, extensions: tuple[str, ...] = EXTENSIONS, max_documents: int = -1
) -> DataFrame:
    """``path, length, content``; a cap is taken in extension order, then by path, before any file is read.

    The cap is one name, found from the listing; Spark leaves out files beyond it
    when it lists the folder again, so their bytes are not opened.
    """
    glob = "*{" + ",".join(extensions) + "}"
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    files = reader.option("pathGlobFilter", glob).load(path)
    if max_documents <= 0:
        return files.select("path", "length", "content")
    name = F.col("_metadata.file_path")
    rank = F.lit(len(extensions))
    for i, extension in enumerate(extensions):
        rank = F.when(F.endswith(name, F.lit(extension)), i).otherwise(rank)
    found = cap_bound(files.select(rank.alias("rank"), name.alias("name")), max_documents, ["rank", "name"])
    if found is None:
        return files.select("path", "length", "content")
    last = found[0].first()
    return files.where((rank < last.rank) | ((rank == last.rank) & (name <= last.name))).select("path", "length", "content")


def _paragraph(p: ET.Element) -> str:
    """Text of the runs of a paragraph, with tabs and line breaks."""
    text = []
    for run in [r for child in p for r in ([child] if child.tag == f"{_W}r" else child.findall(f"{_W}r") if child.tag == f"{_W}hyperlink" else [])]:
        for node in run:
            if node.tag == f"{_W}t":
                text.append(node.text or "")
            elif node.tag == f"{_W}tab":
                text.append("\t")
            elif node.tag == f"{_W}cr" or (node.tag == f"{_W}br" and node.get(f"{_W}type", "textWrapping") == "textWrapping"):
                text.append("\n")
            elif node.tag == f"{_W}noBreakHyphen":
                text.append("-")
    return "".join(text)


def _table(tbl: ET.Element) -> list[list[str]]:
    """Cells as trimmed texts; merged cells repeat their text."""
    rows: list[list[str]] = []
    for tr in tbl.findall(f"{_W}tr"):
        row: list[str] = []
        for tc in tr.findall(f"{_W}tc"):
            span, merge = tc.find(f"{_W}tcPr/{_W}gridSpan"), tc.find(f"{_W}tcPr/{_W}vMerge")
            text = "\n".join(_paragraph(p) for p in tc.findall(f"{_W}p")).strip()
            if merge is not None and merge.get(f"{_W}val", "continue") == "continue" and rows and len(row) < len(rows[-1]):
                text = rows[-1][len(row)]
            row += [text] * (int(span.get(f"{_W}val", 1)) if span is not None else 1)
        rows.append(row)
    return rows


def read_docx(content: bytes) -> dict:
    """Parts of one document; raises if it is not a readable package."""
    with zipfile.ZipFile(io.BytesIO(content)) as package:
        names = set(package.namelist())
        body = ET.fromstring(package.read("word/document.xml")).find(f"{_W}body")
        if body is None:
            raise ValueError("document has no body")
        rels = {}
        if "word/_rels/document.xml.rels" in names:
            for rel in ET.fromstring(package.read("word/_rels/document.xml.rels")).findall(f"{_REL}Relationship"):
                if rel.get("TargetMode") != "External":
                    target = posixpath.normpath(posixpath.join("word", rel.get("Target", "")))
                    rels[rel.get("Id")] = (rel.get("Type", "").rsplit("/", 1)[-1], target.lstrip("/"))

        def marginal(kind: str) -> list[str]:
            # a section without its own reference is linked to the one before
            found = []
            for section in body.iter(f"{_W}sectPr"):
                for ref in section.findall(f"{_W}{kind}Reference"):
                    part = rels.get(ref.get(f"{_R}id"))
                    if ref.get(f"{_W}type", "default") == "default" and part and part[1] in names:
                        texts = (_paragraph(p).strip() for p in ET.fromstring(package.read(part[1])).findall(f"{_W}p"))
                        found += [t for t in texts if t]
            return found

        types, images = {}, []
        if "[Content_Types].xml" in names:
            for node in ET.fromstring(package.read("[Content_Types].xml")):
                types[node.get("PartName", "").lstrip("/") or node.get("Extension", "").lower()] = node.get("ContentType")
        for kind, target in rels.values():
            if kind == "image" and target in names:
                kind_of = types.get(target) or types.get(target.rsplit(".", 1)[-1].lower())
                images.append({"filename": target.rsplit("/", 1)[-1], "content_type": kind_of, "data": package.read(target)})
        core = ET.fromstring(package.read("docProps/core.xml")) if "docProps/core.xml" in names else None
        properties = {}
        for name, tag in PROPERTIES.items():
            text = (core.findtext(tag) or "") if core is not None else ""
            properties[name] = text.replace("T", " ").removesuffix("Z") if name in ("created", "modified") else text
        texts = [_paragraph(p) for p in body.findall(f"{_W}p")]
        return {
            "paragraphs": [t for t in texts if t.strip()],
            "tables": [_table(t) for t in body.findall(f"{_W}tbl")],
            "images": images,
            "headers": marginal("header"),
            "footers": marginal("footer"),
            "properties": properties,
            "error": None,
        }


# Documents whose parts are held as Python objects at one time.
SLICE = 64


def docx_documents(files: DataFrame) -> DataFrame:
    """``content`` -> the extracted parts, or ``error``; all other columns stay.

    The bytes go in and do not come out again. A batch is parsed slice by slice,
    so a worker holds the parts of ``SLICE`` documents, however many a batch has.
    """
    keep = [f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema if f.name != "content"]
    names = [f.name for f in files.schema if f.name != "content"]

    def parts_of(content: bytes | None) -> dict:
        try:
            return read_docx(bytes(content))
        except Exception as e:  # any broken file becomes an error row
            return {"error": f"{type(e).__name__}: {e}"}

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, texts = pa.string(), pa.list_(pa.string())
        types = {
            "paragraphs": texts, "tables": pa.list_(pa.list_(texts)),
            "images": pa.list_(pa.struct([("filename", text), ("content_type", text), ("data", pa.binary())])),
            "headers": texts, "footers": texts, "properties": pa.map_(text, text), "error": text,
        }
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                rows = batch.slice(start, SLICE)
                parts = [parts_of(content.as_py()) for content in rows.column("content")]
                for p in parts:
                    if p.get("properties") is not None:
                        p["properties"] = list(p["properties"].items())
                fields = [pa.array([p.get(field) for p in parts], kind) for field, kind in types.items()]
                yield pa.RecordBatch.from_arrays([*[rows.column(n) for n in names], *fields], names=[*names, *types])

    return files.mapInArrow(extract, ", ".join([*keep, DOCX_FIELDS]))


def extract_documents(
    files: DataFrame,
    separator: str = "\n\n",
    extract_tables: bool = True,
    extract_images: bool = False,
    extract_metadata: bool = True,
    extract_headers_footers: bool = True,
) -> DataFrame:
    """Word packages first; a file that is none but holds HTML is read as HTML; the rest keep their ``error``."""
    with_text = files.withColumn(
        "__html", F.when(~F.startswith("content", F.lit(b"PK")), F.try_validate_utf8(F.col("content").cast("string")))
    )
    parsed = docx_documents(with_text)
    both = html_documents(parsed.withColumnsRenamed({"paragraphs": "__p", "tables": "__t", "images": "__i"}), "__html", separator, extract_tables, extract_images)
    is_docx = F.col("error").isNull()
    is_html = ~is_docx & F.coalesce(F.size("paragraphs") > 0, F.lit(False))
    none = F.array().cast("array<string>")
    docx_images = F.transform(
        "__i",
        lambda x: F.struct(
            x["filename"].alias("filename"), x["content_type"].alias("content_type"), x["data"].alias("data"),
            F.lit(None).cast("string").alias("alt_text"), F.lit(None).cast("int").alias("index"), F.lit(None).cast("string").alias("format"),
        ),
    )
    html_images = F.transform(
        "images",
        lambda x: F.struct(
            F.lit(None).cast("string").alias("filename"), F.lit(None).cast("string").alias("content_type"), F.lit(None).cast("binary").alias("data"),
            x["alt_text"].alias("alt_text"), x["index"].alias("index"), x["format"].alias("format"),
        ),
    )
    images = F.when(is_docx, docx_images).otherwise(html_images)
    paragraphs = F.when(is_docx, F.col("__p")).otherwise(F.col("paragraphs"))
    tables = F.when(is_docx, F.col("__t")).otherwise(F.col("tables"))
    empty_tables = F.array().cast("array<array<array<string>>>")
    return both.select(
        *[c for c in files.columns if c != "content"],
        paragraphs.alias("paragraphs"),
        (tables if extract_tables else empty_tables).alias("tables"),
        (images if extract_images else F.slice(images, 1, 0)).alias("images"),
        (F.coalesce("headers", none) if extract_headers_footers else none).alias("headers"),
        (F.coalesce("footers", none) if extract_headers_footers else none).alias("footers"),
        (F.coalesce("properties", F.create_map().cast("map<string,string>")) if extract_metadata else F.create_map().cast("map<string,string>")).alias("properties"),
        F.array_join(paragraphs, separator).alias("full_text"),
        F.when(is_docx, "docx").when(is_html, "html").alias("extraction_method"),
        F.when(~is_docx & ~is_html, F.col("error")).alias("error"),
    )


def process_documents(
    spark: SparkSession, path: str, min_text_length: int = 50, recursive: bool = True, max_documents: int = -1, **options
) -> DataFrame:
    """Every document found, with its parts and ``ok``: extracted and long enough."""
    files = find_documents(spark, path, recursive, max_documents=max_documents)
    extracted = extract_documents(files, **options)
    ok = F.col("error").isNull() & (F.length("full_text") >= min_text_length)
    return extracted.withColumn("ok", F.coalesce(ok, F.lit(False)))
