"""DOCX files written back and read again."""

import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from corpusprep.functions.text import starts_chapter
from corpusprep.operators import documents
from corpusprep.sinks import docx as sink
from corpusprep.sources import docx

W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
HEAD = f'<w:document xmlns:w="{W}" xmlns:mc="http://schemas.openxmlformats.org/markup-compatibility/2006" xmlns:w14="urn:w14" mc:Ignorable="w14"><w:body>'
FONTS = f'<w:fonts xmlns:w="{W}"><w:font w:name="Arial"/></w:fonts>'


def run(*texts, font=None):
    fonts = f'<w:rPr><w:b/><w:rFonts w:ascii="{font}"/></w:rPr>' if font else ""
    return f"<w:r>{fonts}{''.join(f'<w:t>{t}</w:t>' for t in texts)}</w:r>"


def para(*runs, font=None):
    default = f'<w:pPr><w:rPr><w:rFonts w:cs="{font}"/></w:rPr></w:pPr>' if font else ""
    return f"<w:p>{default}{''.join(runs)}</w:p>"


def made(path, *body, more=None):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", "<Types/>")
        z.writestr("word/document.xml", f"{HEAD}{''.join(body)}<w:sectPr><w:x/></w:sectPr></w:body></w:document>")
        for name, data in (more or {}).items():
            z.writestr(name, data)


def members(path):
    with zipfile.ZipFile(path) as z:
        return {n: z.read(n) for n in z.namelist()}


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    made(
        tmp_path / "in" / "a.docx", para(run("old", "er", font="APS-DV-Prakash"), run("x", font="aps_dv"), run("plain"), run("z", font="Shree-Dev-1"), font="priyanka"), para(run("rest", font="Arial")),
        more={"word/fontTable.xml": FONTS, "word/media/i.png": bytes(range(256)) * 50, "word/header1.xml": f'<w:hdr xmlns:w="{W}">{para(run("h", font="prakash"))}</w:hdr>'},
    )
    made(tmp_path / "in" / "b.docx", para(run("जय जय")), para(run("विषय one")), para(run("Chapter 1")), para(run("text")), f"<w:tbl><w:tr><w:tc>{para(run('cell'))}</w:tc></w:tr></w:tbl>", para(run("Chapter 2")), para(run("two")), more={"word/media/j.png": b"\x00\xff"})
    return tmp_path


CONVERTERS = {"aps": lambda c: F.concat(F.lit(" "), F.upper(c), F.lit("  é")), "shreelipi": F.upper}


def converted(spark, folder):
    return documents.convert_groups(documents.font_groups(docx.runs(spark, str(folder / "in"))), CONVERTERS)


def write_converted(spark, folder, **more):
    name = F.concat(F.lit("msword/"), F.element_at(F.split("doc", "/"), -1))
    sink.write_documents(sink.converted_documents(spark, str(folder / "in"), converted(spark, folder), name), str(folder / "out"), **more)


def test_converted_text_reads_back(spark, folder):
    write_converted(spark, folder)
    got = {(r.part, r.para_no, r.run_no): (r.text, list(r.fonts)) for r in docx.runs(spark, str(folder / "out" / "msword" / "a.docx")).collect()}
    new = [sink.FONT] * 4
    assert got == {("word/document.xml", 0, 0): (" OLDERX  é", new), ("word/document.xml", 0, 1): ("", new), ("word/document.xml", 0, 2): ("plain", []), ("word/document.xml", 0, 3): ("Z", new), ("word/document.xml", 1, 0): ("rest", ["Arial"]), ("word/header1.xml", 0, 0): (" H  é", new)}
    before, after = members(folder / "in" / "a.docx"), members(folder / "out" / "msword" / "a.docx")
    assert list(before) == list(after) and {n for n in before if before[n] != after[n]} == {"word/document.xml", "word/header1.xml", "word/fontTable.xml"}
    xml = after["word/document.xml"].decode()
    assert '<w:t xml:space="preserve"> OLDERX  é</w:t><w:t />' in xml and "<w:t>Z</w:t>" in xml, "the mark stands where white space needs it"
    assert 'xmlns:w14="urn:w14"' in xml and 'mc:Ignorable="w14"' in xml and "priyanka" not in xml and "<w:b />" in xml
    assert after["word/fontTable.xml"].decode().count(f'w:name="{sink.FONT}"') == 1 and '<w:charset w:val="00" /><w:family w:val="auto" /><w:pitch w:val="variable" />' in after["word/fontTable.xml"].decode()
    assert sink.font_table(after["word/fontTable.xml"]) == after["word/fontTable.xml"]
    assert {r.text for r in docx.paragraphs(spark, str(folder / "out" / "msword" / "b.docx")).collect()} == {r.text for r in docx.paragraphs(spark, str(folder / "in" / "b.docx")).collect()}


def test_a_group_without_conversion_stays(spark, folder):
    left = documents.convert_groups(documents.font_groups(docx.runs(spark, str(folder / "in" / "a.docx"))), {"shreelipi": F.upper})
    r = sink.converted_documents(spark, str(folder / "in" / "a.docx"), left, F.lit("a")).first()
    with zipfile.ZipFile(io.BytesIO(bytes(r.content))) as z:
        assert b"<w:t>old</w:t><w:t>er</w:t>" in z.read("word/document.xml")


def test_chapter_documents(spark, folder):
    blocks = docx.blocks(spark, str(folder / "in" / "b.docx"))
    made_of = sink.chapter_documents(spark, str(folder / "in" / "b.docx"), blocks, starts_chapter(F.col("text"), "Chapter "), F.format_string("c%03d.docx", "chapter_no"))
    sink.write_documents(made_of, str(folder / "chapters"))
    assert sorted(os.listdir(folder / "chapters")) == ["c001.docx", "c002.docx"]
    got = {n: [(r.tag, r.text) for r in docx.blocks(spark, str(folder / "chapters" / n)).orderBy("block_no").collect()] for n in os.listdir(folder / "chapters")}
    assert got["c001.docx"] == [("p", "विषय one"), ("p", "Chapter 1"), ("p", "text"), ("tbl", ""), ("sectPr", "")] and got["c002.docx"] == [("p", "विषय one"), ("p", "Chapter 2"), ("p", "two"), ("sectPr", "")]
    before, after = members(folder / "in" / "b.docx"), members(folder / "chapters" / "c001.docx")
    assert list(before) == list(after) and {n for n in before if before[n] != after[n]} == {"word/document.xml"}
    assert {r.text for r in documents.chapters(docx.blocks(spark, str(folder / "chapters" / "c002.docx")), "Chapter ").collect()} == {"विषय one\n\nChapter 2\n\ntwo"}


def test_files_come_together_or_not_at_all(spark, folder):
    out = folder / "out"
    rows = spark.createDataFrame([(f"n{i}.bin", bytes([i])) for i in range(20)], sink.FILES).repartition(4)
    broken = rows.withColumn("name", F.when(F.col("name") == "n13.bin", "../x").otherwise(F.col("name")))
    with pytest.raises(Exception, match="no name below"):
        sink.write_documents(broken, str(out))
    assert not out.exists() or not [n for n in os.listdir(out) if not n.startswith("_")]
    sink.write_documents(rows, str(out))
    assert len([n for n in os.listdir(out) if not n.startswith("_")]) == 20
    with pytest.raises(Exception, match="n7.bin"):
        sink.write_documents(spark.createDataFrame([("new.bin", b"x"), ("n7.bin", b"y")], sink.FILES), str(out))
    assert not (out / "new.bin").exists() and (out / "n7.bin").read_bytes() == bytes([7])
    sink.write_documents(spark.createDataFrame([("n7.bin", b"y")], sink.FILES), str(out), overwrite=True)
    assert (out / "n7.bin").read_bytes() == b"y"
