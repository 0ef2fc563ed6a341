import io
import zipfile
from html.parser import HTMLParser

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logloom.operators import documents as H
from logloom.sinks import writers as K
from logloom.sources import documents as S

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def p(text):
    return f"<w:p><w:r><w:t>{text}</w:t></w:r></w:p>"


def package(body, extra=None):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body>{body}</w:body></w:document>")
        for name, data in (extra or {}).items():
            z.writestr(name, data)
    return out.getvalue()


FULL = package(
    p("First") + p(" ") + "<w:p><w:r><w:t>a</w:t><w:tab/><w:t>b</w:t><w:br/><w:t>c</w:t></w:r><w:hyperlink><w:r><w:t>link</w:t></w:r></w:hyperlink></w:p>"
    + "<w:tbl><w:tr><w:tc><w:tcPr><w:gridSpan w:val='2'/></w:tcPr>" + p(" wide ") + "</w:tc><w:tc><w:tcPr><w:vMerge w:val='restart'/></w:tcPr>" + p("tall") + "</w:tc></w:tr>"
    + "<w:tr><w:tc>" + p("x") + p("y") + "</w:tc><w:tc>" + p("z") + "</w:tc><w:tc><w:tcPr><w:vMerge/></w:tcPr>" + p("") + "</w:tc></w:tr></w:tbl>"
    + "<w:p><w:pPr><w:sectPr><w:headerReference w:type='default' r:id='h1'/></w:sectPr></w:pPr></w:p>"
    + "<w:sectPr><w:footerReference w:type='default' r:id='f1'/></w:sectPr>",
    {
        "word/_rels/document.xml.rels": f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        f'<Relationship Id="h1" Type="{OFFICE}/header" Target="header1.xml"/><Relationship Id="f1" Type="{OFFICE}/footer" Target="footer1.xml"/>'
        f'<Relationship Id="i1" Type="{OFFICE}/image" Target="media/image1.png"/></Relationships>',
        "word/header1.xml": f"<w:hdr {W}>{p(' Top ')}{p('')}</w:hdr>",
        "word/footer1.xml": f"<w:ftr {W}>{p('Bottom')}</w:ftr>",
        "word/media/image1.png": b"\x89PNG",
        "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="png" ContentType="image/png"/></Types>',
        "docProps/core.xml": '<cp:coreProperties xmlns:cp="http://schemas.openxmlformats.org/package/2006/metadata/core-properties" xmlns:dc="http://purl.org/dc/elements/1.1/" '
        'xmlns:dcterms="http://purl.org/dc/terms/"><dc:creator>Me</dc:creator><dcterms:created>2024-01-02T03:04:05Z</dcterms:created></cp:coreProperties>',
    },
)


def test_word_folder(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "full.docx").write_bytes(FULL)
    odd = tmp_path / "odd"
    odd.mkdir()
    (odd / "a [1] {x}.docx").write_bytes(FULL)
    assert S.find_documents(spark, str(odd), max_documents=3).count() == 1
    (odd / "a [1] {x}.docx").unlink()
    (tmp_path / "sub" / "short.docx").write_bytes(package(p("tiny")))
    (tmp_path / "sub" / "web.doc").write_bytes("<html><p>Ünï &amp; code</p></html>".encode())
    (tmp_path / "sub" / "old.doc").write_bytes(b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1")
    (tmp_path / "sub" / "cut.docx").write_bytes(FULL[:100])
    (tmp_path / "note.txt").write_text("no")
    path = str(tmp_path)
    rows = {r.path.rsplit("/", 1)[1]: r for r in S.process_documents(spark, path, min_text_length=10, extract_images=True).collect()}
    assert set(rows) == {"full.docx", "short.docx", "web.doc", "old.doc", "cut.docx"}
    full = rows["full.docx"]
    assert full.paragraphs == ["First", "a\tb\nclink"] and full.full_text == "First\n\na\tb\nclink" and full.ok
    assert full.tables == [[["wide", "wide", "tall"], ["x\ny", "z", "tall"]]]
    assert full.headers == ["Top"] and full.footers == ["Bottom"]
    assert full.properties == {"title": "", "author": "Me", "created": "2024-01-02 03:04:05", "modified": "", "last_modified_by": ""}
    assert (full.images[0].filename, full.images[0].content_type, bytes(full.images[0].data)) == ("image1.png", "image/png", b"\x89PNG")
    assert (rows["web.doc"].extraction_method, rows["web.doc"].full_text) == ("html", "Ünï & code")
    assert rows["old.doc"].error and rows["cut.docx"].error and not rows["old.doc"].ok
    assert rows["short.docx"].error is None and not rows["short.docx"].ok
    assert S.find_documents(spark, path, recursive=False).count() == 1
    assert [r.path.rsplit("/", 1)[1] for r in S.find_documents(spark, path, max_documents=4).orderBy("path").collect()] == [
        "full.docx", "cut.docx", "old.doc", "short.docx"
    ]
    total = H.summary(S.process_documents(spark, path, min_text_length=10)).first()
    assert (total.total, total.succeeded, total.failed, total.success_rate) == (5, 2, 3, 40.0)

    docs = S.process_documents(spark, path, extract_images=True).where("error is null")
    meta = H.with_metadata(docs.withColumn("path", F.regexp_replace("path", "^file:", "")), path)
    got = {r.metadata.filename: r.metadata for r in meta.collect()}
    assert (got["web.doc"].category, got["full.docx"].category, got["web.doc"].relative_path) == ("sub", ".", "sub/web.doc")
    assert K.image_table(docs).count() == 1
    K.write_documents(meta, f"{path}/out", "json")
    back = spark.read.json(f"{path}/out")
    assert back.count() == 3 and {r.category for r in back.select("category").collect()} == {"sub", "."}
    image = back.where("metadata.filename = 'full.docx'").select(F.explode("images").alias("i")).select("i.*").first()
    assert (image.data, image.encoding) == ("iVBORw==", "base64")
    K.write_documents(meta, f"{path}/text", "plain_text", by_category=False)
    with pytest.raises(ValueError):
        K.write_documents(meta, f"{path}/x", "pdf")


def test_html_golden(spark):
    html = '<p>a</p><p> </p><table><tr><th> h </th><td>1</td></tr></table><img alt="x"><img src=y>'
    df = spark.createDataFrame([(html,), ("<p>one<br>two <b>three</b><div>no</div><p>four &lt;x&gt; &amp;amp;",), ("<p>caf&eacute; &#39;&amp;lt;&#x41;'",)], "html string")
    a, b, c = H.html_documents(df, extract_images=True, include_raw_html=True).collect()
    assert a.paragraphs == ["a"] and a.tables == [[["h", "1"]]] and a.raw_html == html
    assert [(i["alt_text"], i["index"]) for i in a.images] == [("x", 0), ("", 1)]
    assert b.paragraphs == ["onetwo three", "four <x> &amp;"] and b.tables == []
    assert c.paragraphs == ["café '&lt;A'"]


def test_nested_tables(spark):
    html = "<table><tr><td>a<table><tr><td>in</td></tr></table></td><td>b</td></tr></table>"
    df = spark.createDataFrame([(html,), ("<table><tr><td>q</table>",)], "html string")
    a, b = H.html_documents(df).collect()
    assert a.tables == [[["ain", "in", "b"], ["in"]], [["in"]]]
    assert b.tables == [[["q"]]]


class Paragraphs(HTMLParser):
    """Brute force: what an open paragraph collects until a block element starts or ends."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found, self.open, self.skip = [], None, 0

    def close_p(self):
        if self.open is not None:
            self.found.append("".join(self.open))
        self.open = None

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skip += 1
        elif tag in H.BLOCKS:
            self.close_p()
            if tag == "p":
                self.open = []

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skip -= 1
        elif tag in H.BLOCKS:
            self.close_p()

    def handle_data(self, data):
        if self.open is not None and not self.skip:
            self.open.append(data)


def test_pages_against_parser(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r.paragraphs for r in H.html_documents(pages).select("page_id", "paragraphs").collect()}
    for row in pages.collect():
        parser = Paragraphs()
        parser.feed(row.html)
        parser.close()
        parser.close_p()
        want = [x for x in parser.found if x.strip()]
        assert [x.replace("\xa0", " ") for x in got[row.page_id]] == [x.replace("\xa0", " ") for x in want], row.page_id


def test_packages_are_parsed_slice_by_slice(spark, monkeypatch):
    """A batch of many packages comes out in small ones, so the parsed parts of a whole batch are never held."""
    seen = {}
    files = spark.createDataFrame([(1, bytearray(b"x"))], "doc_id long, content binary")
    monkeypatch.setattr(type(files), "mapInArrow", lambda self, fn, schema: seen.update(fn=fn), raising=True)
    S.docx_documents(files)
    good = package(p("text"))
    batch = pa.record_batch({"doc_id": pa.array([None, *range(2**60, 2**60 + 199)], pa.int64()), "content": pa.array([None, *[good] * 198, b"PK broken"], pa.binary())})
    out = list(seen["fn"](iter([batch])))
    assert max(b.num_rows for b in out) <= S.SLICE
    rows = pa.Table.from_batches(out).to_pylist()
    assert [r["doc_id"] for r in rows] == batch.column("doc_id").to_pylist()
    assert all(r["error"] is None and r["paragraphs"] for r in rows[1:-1]) and rows[0]["error"] and rows[-1]["error"]
