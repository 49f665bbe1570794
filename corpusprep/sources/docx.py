"""DOCX files as rows. A file is a zip with XML parts; each is parsed by the task that reads it."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
MAIN = "word/document.xml"
TEXT_PART = re.compile(r"word/(document|footnotes|endnotes|comments|header[0-9]+|footer[0-9]+)\.xml")
FONT_SLOTS = ("ascii", "hAnsi", "cs", "eastAsia")


def _text(node: ElementTree.Element) -> str:
    return "".join(t.text or "" for t in node.iter(f"{W}t"))


def _scan(spark: SparkSession, path: str, rows_of: Callable[[str, zipfile.ZipFile], Iterator[tuple]], columns: str) -> DataFrame:
    names = [c.split()[0] for c in columns.split(", ")]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for p, content in zip(b["path"], b["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(bytes(content))) as z:
                    yield pd.DataFrame(list(rows_of(p, z)), columns=names)

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").load(path).select("path", "content").mapInPandas(parse, columns)


def _parts(z: zipfile.ZipFile) -> list[str]:
    return [n for n in z.namelist() if TEXT_PART.fullmatch(n)]


def blocks(spark: SparkSession, path: str) -> DataFrame:
    """Top-level children of each body: doc, block_no, tag (p, tbl, sectPr, ...), text. Only paragraphs have text here."""

    def rows(p: str, z: zipfile.ZipFile) -> Iterator[tuple]:
        body = ElementTree.fromstring(z.read(MAIN)).find(f"{W}body")
        if body is None:
            raise ValueError(f"{p} has no body")
        for i, child in enumerate(body):
            tag = child.tag.rpartition("}")[2]
            yield p, i, tag, _text(child) if tag == "p" else ""

    return _scan(spark, path, rows, "doc string, block_no int, tag string, text string")


def paragraphs(spark: SparkSession, path: str) -> DataFrame:
    """All paragraphs of all text parts, in zip order, those of tables too: doc, part_no, part, para_no, text."""

    def rows(p: str, z: zipfile.ZipFile) -> Iterator[tuple]:
        for k, part in enumerate(_parts(z)):
            for i, para in enumerate(ElementTree.fromstring(z.read(part)).iter(f"{W}p")):
                yield p, k, part, i, _text(para)

    return _scan(spark, path, rows, "doc string, part_no int, part string, para_no int, text string")


def runs(spark: SparkSession, path: str) -> DataFrame:
    """Runs of all paragraphs: doc, part, para_no, run_no, fonts (names in their slots), n_texts, text."""

    def rows(p: str, z: zipfile.ZipFile) -> Iterator[tuple]:
        for part in _parts(z):
            for i, para in enumerate(ElementTree.fromstring(z.read(part)).iter(f"{W}p")):
                for j, run in enumerate(para.findall(f"{W}r")):
                    fonts = run.find(f"{W}rPr/{W}rFonts")
                    names = [] if fonts is None else [v for k, v in fonts.attrib.items() if k.rpartition("}")[2] in FONT_SLOTS]
                    texts = run.findall(f"{W}t")
                    yield p, part, i, j, names, len(texts), "".join(t.text or "" for t in texts)

    return _scan(spark, path, rows, "doc string, part string, para_no int, run_no int, fonts array<string>, n_texts int, text string")


def validity(spark: SparkSession, path: str) -> DataFrame:
    """Whether each file is a sound zip whose main part parses: path, ok, reason."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for p, content in zip(b["path"], b["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(bytes(content))) as z:
                        bad = z.testzip()
                        if bad is None:
                            ElementTree.fromstring(z.read(MAIN))
                    out.append((p, bad is None, None if bad is None else f"damaged member {bad}"))
                except (zipfile.BadZipFile, KeyError, ElementTree.ParseError) as e:
                    out.append((p, False, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["path", "ok", "reason"])

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").load(path).select("path", "content").mapInPandas(parse, "path string, ok boolean, reason string")
