import io
import zipfile

import pytest

from tomeflow.operators import search, store
from tomeflow.operators.pipeline import Pipeline
from tomeflow.sources import office
from tomeflow.sources.files import convert, problems, scan
from tomeflow.sources.settings import Settings
from tomeflow.streaming.ingest import build_stream

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def docx(body, types="document.main"):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("[Content_Types].xml", f"<Types>{types}</Types>")
        z.writestr("word/styles.xml", f'<w:styles {W}><w:style w:styleId="H1"><w:name w:val="heading 1"/></w:style></w:styles>')
        z.writestr("word/document.xml", f"<w:document {W}><w:body>{body}</w:body></w:document>")
    return b.getvalue()


DOCX = docx('<w:p><w:pPr><w:pStyle w:val="H1"/></w:pPr><w:r><w:t>Title</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr></w:tbl><w:p><w:r><w:t>end</w:t></w:r></w:p>')
PROSE = "# Heading\n\nThe first pump stands next to the second valve and must be checked every week."


def test_office():
    assert office.read_docx(DOCX) == "# Title\n\n| a | b |\n\nend"
    assert office.read_docx_plain(DOCX).startswith("Title")
    assert office.sniff("docx", docx("", "macroEnabled")) and office.sniff("docx", b"no zip") == "no zip archive"
    assert office.sniff("docx", DOCX) is None and office.sniff("txt", b" ") == "blank"


def zipped(**files):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        for name, text in files.items():
            z.writestr(name.replace("__", "/").replace("_dot_", "."), text)
    return b.getvalue()


def test_docx_that_is_broken():
    text = f"<w:document {W}><w:body><w:p><w:r><w:t>kept</w:t></w:r></w:p></w:body></w:document>"
    assert office.read_docx_or_plain(zipped(word__styles_dot_xml="<broken", word__document_dot_xml=text)) == "kept"
    assert office.read_docx_or_plain(zipped(Word__document_dot_xml=text)) == "kept"
    with pytest.raises(ValueError, match="document.xml"):
        office.read_docx_or_plain(zipped(x="y"))


def test_xlsx():
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    row = '<row><c r="A1"{a}><v>{v}</v></c><c r="C1" t="b"><v>1</v></c></row>'
    sheet = "".join(row.format(a=a, v=v) for a, v in ((' s="1"', "45292"), (' s="2"', "45292.75"), (' s="1"', "0.5"), ("", "45292"), (' s="3"', "7")))
    book = dict(
        xl__workbook_dot_xml=f'<workbook {ns}><sheets><sheet name="S" r:id="r1"/></sheets></workbook>', xl___rels__workbook_dot_xml_dot_rels='<R><Relationship Id="r1" Target="worksheets/s.xml"/></R>',
        xl__styles_dot_xml=f'<styleSheet {ns}><numFmts><numFmt numFmtId="170" formatCode="yyyy&quot;x&quot;-mm"/><numFmt numFmtId="171" formatCode="0 [Red]&quot;days&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs></styleSheet>',
        xl__worksheets__s_dot_xml=f'<worksheet {ns}><sheetData>{sheet}<row><c r="A9" t="b"><v>0</v></c></row><row><c r="A10"><v>0</v></c></row></sheetData></worksheet>',
    )
    rows = office.read_xlsx(zipped(**book)).split("\n")
    assert [r.split(" | ")[0].lstrip("| ") for r in rows[2:] if "---" not in r] == ["2024-01-01 00:00:00", "2024-01-01 18:00:00", "12:00:00", "45292", "7", "False"]
    assert rows[2].endswith("|  | True |")


class FakePdf:
    opened = 0

    class Page:
        def __init__(self, text):
            self.text = text

        def extract_text(self):
            if self.text == "!":
                raise ValueError("broken page")
            return self.text

    def __init__(self, stream):
        FakePdf.opened += 1
        self.pages = [self.Page(t) for t in stream.read().decode().split("|")]


def test_pdf(monkeypatch):
    assert office.read_pdf(b"a| |!|b ", FakePdf) == "<!-- Page 1 -->\n\na\n\n<!-- Page 4 -->\n\nb"
    with pytest.raises(office.NoText, match="scanned"):
        office.read_pdf(b" |!", FakePdf)
    monkeypatch.setattr(office, "PAGES", 2)
    FakePdf.opened = 0
    assert office.read_pdf(b"a|b|c|d|e", FakePdf).count("Page") == 5 and FakePdf.opened == 4


def test_limits(spark, tmp_path, monkeypatch):
    """A reader that takes too long and an archive that unpacks to too much are rows with an error; readers may be brought along."""
    import time

    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.4 slow")
    (tmp_path / "b.pptx").write_bytes(zipped(ppt__slides__slide1_dot_xml="<a><p><t>x</t></p></a>"))

    def slow(content):
        time.sleep(5)

    def scanned(content):
        from tomeflow.sources.office import NoText

        raise NoText("no text on any page (possibly scanned)")

    began = time.time()
    got = {r.rel_path: r for r in convert(scan(spark, str(tmp_path)), readers={"pdf": slow}, seconds=1).collect()}
    assert got["a.pdf"].status == "error" and "stopped after 1 s" in got["a.pdf"].error and got["b.pptx"].status == "ok" and time.time() - began < 30
    got = {r.rel_path: r for r in convert(scan(spark, str(tmp_path)), readers={"pdf": scanned, "pptx": lambda c: "# own reader"}).collect()}
    assert (got["a.pdf"].status, got["b.pptx"].status) == ("empty", "ok") and "scanned" in got["a.pdf"].error
    monkeypatch.setattr(office, "UNPACKED", 10)
    with pytest.raises(ValueError, match="unpacks"):
        office.read_pptx(zipped(x="y" * 100))


def test_lifecycle(spark, tmp_path):
    src, out = tmp_path / "src", tmp_path / "out"
    (src / "d").mkdir(parents=True)
    (src / "d/a.md").write_text(PROSE)
    (src / "b.txt").write_bytes("你好，世界。泵在这里！".encode("gbk"))
    (src / "c.docx").write_bytes(DOCX)
    (src / "e.txt").write_text(" ")
    (src / "g.md").write_text("ab cd")
    (src / "x.sql").write_text("SELECT 1; SELECT 2;" + " -- one two three four five six seven eight nine ten words here")
    (src / "bad.docx").write_bytes(b"no")
    got = {r.rel_path: r for r in convert(scan(spark, str(src))).collect()}
    assert {k: r.status for k, r in got.items()} == {"d/a.md": "ok", "b.txt": "ok", "c.docx": "ok", "e.txt": "empty", "g.md": "garbled", "x.sql": "ok", "bad.docx": "error"}
    assert got["b.txt"].markdown.startswith("你好")
    assert [r.rel_path for r in problems(scan(spark, str(src))).orderBy("rel_path").collect()] == ["bad.docx", "e.txt"]

    p = Pipeline(spark, str(src), str(out), Settings())
    assert {r.reason for r in p.build().collect()} == {"new"}
    n = p.base.table("chunks").count()
    assert n == 4 and p.base.table("postings", "term string").count() > 0
    assert {r.reason for r in p.build().collect()} == {"skip", "retry"}
    assert p.base.table("chunks").count() == n
    (src / "d/a.md").write_text(PROSE + " Another line of words.")
    assert {r.rel_path: r.reason for r in p.build().collect()}["d/a.md"] == "changed"
    assert p.base.table("chunks").count() == n
    assert p.base.table("chunks").where("source = 'd/a.md' and text like '%Another%'").count() == 1
    s = {r.stage: r for r in p.status().collect()}
    assert s["conversion"].ok == 4 and s["conversion"].error == 1
    p.delete(prefix="d/")
    assert p.base.table("chunks").where("source like 'd/%'").count() == 0 and p.state().count() == 6
    assert p.build("full").count() == 7 and p.base.table("chunks").count() == n
    p.retry()
    assert p.base.table("chunks").count() == n


def test_stream(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.md").write_text(PROSE)
    p = Pipeline(spark, str(src), str(tmp_path / "out"))
    for n in (1, 2):
        build_stream(p, str(tmp_path / "ck")).awaitTermination()
        assert p.base.table("chunks").select("source").distinct().count() == n
        (src / "b.md").write_text(PROSE + " More.")


def test_a_change_writes_one_bucket(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    for i in range(12):
        (src / f"f{i}.md").write_text(f"{PROSE} Number {i}.")
    embedded = []

    def embed(texts, key, text):
        embedded.append(texts.count())
        return texts.selectExpr(key, f"array(1.0D, cast(length({text}) as double)) AS vector")

    p = Pipeline(spark, str(src), str(tmp_path / "out"), embed=embed)
    p.build()
    first = {k: t["buckets"] for k, t in p.base.manifest()["tables"].items()}
    assert set(first) == {"chunks", "postings", "lengths", "vectors"} and len(first["chunks"]) > 3
    assert {r.reason for r in p.build().collect()} == {"skip"} and embedded[1:] in ([], [0])
    (src / "f3.md").write_text(PROSE + " A new number three.")
    assert sorted(r.reason for r in p.build().collect()) == ["changed"] + ["skip"] * 11
    for name, buckets in p.base.manifest()["tables"].items():
        assert sum(first[name].get(b) != v for b, v in buckets["buckets"].items()) == 1, name
    assert embedded[-1] == 1 and p.base.table("vectors").count() == p.base.table("chunks").count() == p.base.index().lengths.count() == 12
    assert p.base.table("postings").where("term = 'three'").count() == 1
    (src / "f3.md").write_text(" ")
    p.build()
    assert p.base.table("chunks").where("source = 'f3.md'").count() == 0 and p.base.table("chunks").count() == 11
    assert len(p.base.versions()) == store.KEPT and p.base.version() > store.KEPT
    asked = spark.createDataFrame([(1, "pump", "first pump")], "query_id int, question string, expanded string")
    with pytest.raises(ValueError, match="components"):
        search.hybrid_hits(asked, p.base.index(), embed=lambda df, key, text: df.selectExpr(key, "array(1.0D) AS vector"))
    assert search.hybrid_hits(asked, p.base.index(), embed=embed).count() == 5
    p.export(str(tmp_path / "md"))
    assert "Number 1." in next((tmp_path / "md" / "file=f1.md").glob("*.txt")).read_text()


def test_markdown_of_another_run(spark, tmp_path):
    """Markdown that was converted elsewhere is taken as converted, whatever it looks like."""
    (tmp_path / "md").mkdir()
    (tmp_path / "md" / "a.md").write_text("ab cd")
    (tmp_path / "md" / "b.md").write_text(" ")
    p = Pipeline(spark, str(tmp_path / "none"), str(tmp_path / "out"))
    assert [tuple(r) for r in p.import_markdown(str(tmp_path / "md")).select("rel_path", "action").collect()] == [("a.md", "ingest"), ("b.md", "convert")]
    assert [r.text for r in p.base.table("chunks").collect()] == ["ab cd"]
    assert {(r.rel_path, r.conversion.status, r.ingestion.status) for r in p.state().collect()} == {("a.md", "ok", "ok"), ("b.md", "empty", "pending")}


def test_store(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "source string, n int")
    new = spark.createDataFrame([("a", 9, "x")], "source string, n int, doc_type string")
    assert sorted((r.source or "", r.n) for r in store.replaced(old, new).collect()) == [("", 3), ("a", 9), ("b", 2)]
    assert store.impact(old, store.doomed(prefix="a%")).first().chunks == 0
    assert store.stats(old).first() == (3, 2)


def test_settings(tmp_path):
    f = tmp_path / ".env"
    f.write_text("TOMEFLOW_CHUNK_SIZE=500\nTOMEFLOW_GLOSSARY_PATH=g\nTOMEFLOW_TOP_K=x\n")
    s = Settings.from_env({"TOMEFLOW_THRESHOLD": "0.7", "TOMEFLOW_STRIP_BOILERPLATE": "false"}, str(f))
    assert (s.chunk_size, s.glossary_path, s.top_k, s.threshold, s.strip_boilerplate) == (500, "g", 5, 0.7, False)
    assert Settings().chunk_size == 1200 and len(s.warnings()) == 1 and len(Settings(threshold=2.0, top_k=0).warnings()) == 3
