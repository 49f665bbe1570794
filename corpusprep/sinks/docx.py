"""DOCX files written back: converted text in place of legacy text, and one document for each chapter.

One member of a file's zip is built anew in the task that has the file; all other members keep their bytes, names and order.
Namespaces that a part declares are declared again, used or not, since attributes such as ``Ignorable`` name prefixes.

Files are written by a batch writer: tasks write to a folder of their job that no reader looks into, and commit moves
what the successful tasks wrote to its place; a failed job leaves nothing. Without overwrite a file that is there stops the
commit before any file is moved.
"""

from __future__ import annotations

import io
import os
import re
import uuid
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..operators.documents import FONT_PATTERNS, chapter_numbers, subject_headings
from ..sources.docx import FONT_SLOTS, MAIN, TEXT_PART, W

SPACE = "{http://www.w3.org/XML/1998/namespace}space"
FONT_TABLE = "word/fontTable.xml"
#: The font of converted text.
FONT = "Noto Sans Devanagari"
FILES = "name string, content binary"


def _parse(xml: bytes) -> tuple[ElementTree.Element, dict[str, str]]:
    """The tree of a part and the prefixes that it declares."""
    prefixes: dict[str, str] = {}
    root = None
    for event, value in ElementTree.iterparse(io.BytesIO(xml), events=("start-ns", "start")):
        if event == "start-ns":
            prefixes.setdefault(*value)
        elif root is None:
            root = value
    return root, prefixes


def _spell(root: ElementTree.Element, prefixes: dict[str, str]) -> bytes:
    own = ElementTree._namespace_map.copy()  # noqa: SLF001  the names of prefixes are a setting of the whole process
    try:
        for prefix, uri in prefixes.items():
            if prefix and not re.fullmatch(r"ns\d+", prefix):
                ElementTree.register_namespace(prefix, uri)
        text = ElementTree.tostring(root, encoding="unicode")
    finally:
        ElementTree._namespace_map.clear()  # noqa: SLF001
        ElementTree._namespace_map.update(own)  # noqa: SLF001
    head = text[: text.index(">")]
    lost = "".join(f' xmlns:{p}="{uri}"' for p, uri in prefixes.items() if p and f"xmlns:{p}=" not in head)
    at = re.match(r"<[^\s/>]+", text).end()
    return b'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n' + (text[:at] + lost + text[at:]).encode()


def _rezip(content: bytes, changed: dict[str, bytes]) -> bytes:
    """The zip with some members replaced; the others keep bytes, names, dates and order."""
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(content)) as source, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as target:
        for info in source.infolist():
            target.writestr(info, changed.get(info.filename, None) if info.filename in changed else source.read(info.filename))
    return out.getvalue()


def _set_fonts(fonts: ElementTree.Element, font: str) -> None:
    for slot in FONT_SLOTS:
        fonts.set(f"{W}{slot}", font)


def _first(parent: ElementTree.Element, tag: str) -> ElementTree.Element:
    """The child of that tag, made as the first child where there is none."""
    found = parent.find(tag)
    if found is None:
        found = ElementTree.Element(tag)
        parent.insert(0, found)
    return found


def _is_legacy(fonts: ElementTree.Element) -> bool:
    names = [fonts.get(f"{W}{slot}", "").lower() for slot in FONT_SLOTS]
    return any(p in n for n in names for patterns in FONT_PATTERNS.values() for p in patterns)


def _set_text(node: ElementTree.Element, text: str) -> None:
    """White space at an end, or two in a row, is kept by a mark; a mark that is not needed goes."""
    node.text = text
    if text != text.strip() or re.search(r"\s\s", text):
        node.set(SPACE, "preserve")
    else:
        node.attrib.pop(SPACE, None)


def converted_part(xml: bytes, edits: dict[tuple[int, int], tuple[int, str]], font: str = FONT) -> bytes:
    """A text part with the text of some groups of runs replaced. ``edits``: (paragraph, first run) to (last run, text). A group's
    first text node takes all of its text, its others are emptied; its runs, and every legacy font of the part, get ``font``."""
    root, prefixes = _parse(xml)
    for number, para in enumerate(root.iter(f"{W}p")):
        runs = para.findall(f"{W}r")
        for first in range(len(runs)):
            if (number, first) not in edits:
                continue
            last, text = edits[number, first]
            nodes = [t for r in runs[first : last + 1] for t in r.findall(f"{W}t")]
            for k, node in enumerate(nodes):
                _set_text(node, text if k == 0 else "")
            for r in runs[first : last + 1]:
                _set_fonts(_first(_first(r, f"{W}rPr"), f"{W}rFonts"), font)
    for fonts in root.iter(f"{W}rFonts"):
        if _is_legacy(fonts):
            _set_fonts(fonts, font)
    return _spell(root, prefixes)


def font_table(xml: bytes, font: str = FONT) -> bytes:
    """A font table that lists ``font``; one that does already keeps its bytes."""
    root, prefixes = _parse(xml)
    if any(f.get(f"{W}name") == font for f in root.findall(f"{W}font")):
        return xml
    entry = ElementTree.SubElement(root, f"{W}font", {f"{W}name": font})
    for tag, value in (("charset", "00"), ("family", "auto"), ("pitch", "variable")):
        ElementTree.SubElement(entry, f"{W}{tag}", {f"{W}val": value})
    return _spell(root, prefixes)


def converted_document(content: bytes, edits: dict[str, dict[tuple[int, int], tuple[int, str]]], font: str = FONT) -> bytes:
    """A DOCX file with the edits of its parts. Without any edit a part still loses its legacy fonts."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        changed = {n: converted_part(z.read(n), edits.get(n, {}), font) for n in z.namelist() if TEXT_PART.fullmatch(n)}
        if FONT_TABLE in z.namelist():
            changed[FONT_TABLE] = font_table(z.read(FONT_TABLE), font)
    return _rezip(content, changed)


def chapter_document(content: bytes, blocks: set[int]) -> bytes:
    """A DOCX file whose body has only the top-level children of these numbers, and the section properties."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        root, prefixes = _parse(z.read(MAIN))
    body = root.find(f"{W}body")
    for number, child in enumerate(list(body)):
        if number not in blocks and child.tag != f"{W}sectPr":
            body.remove(child)
    return _rezip(content, {MAIN: _spell(root, prefixes)})


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").load(path).select(F.col("path").alias("doc"), "content")


def converted_documents(spark: SparkSession, path: str, converted: DataFrame, name: Column, font: str = FONT) -> DataFrame:
    """``name``, ``content`` of each DOCX file below ``path`` with its converted groups (``documents.convert_groups``; a group without a
    conversion stays as it is). ``name`` is a column of ``doc``, the file's path."""
    kept = converted.where(F.col("converted").isNotNull()).groupBy("doc").agg(F.collect_list(F.struct("part", "para_no", "first_run", "last_run", "converted")).alias("edits"))
    both = _files(spark, path).join(kept, "doc", "left").select(name.alias("name"), "content", "edits")

    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for n, content, edits in zip(b["name"], b["content"], b["edits"], strict=True):
                of: dict[str, dict] = {}
                for e in [] if edits is None else edits:
                    of.setdefault(e["part"], {})[e["para_no"], e["first_run"]] = (e["last_run"], e["converted"])
                yield pd.DataFrame({"name": [n], "content": [converted_document(bytes(content), of, font)]})

    return both.mapInPandas(rewrite, FILES)


def chapter_documents(spark: SparkSession, path: str, blocks: DataFrame, starts: Column, name: Column) -> DataFrame:
    """``name``, ``content`` of one DOCX file for each chapter: the heading blocks of its document, its own blocks, the section properties, and
    all other members of the source. ``blocks`` as ``sources.docx.blocks`` gives them; ``starts`` tells the paragraphs that start chapters;
    ``name`` is a column of ``doc`` and ``chapter_no``."""
    content = blocks.where(F.col("tag") != "sectPr")
    numbered = chapter_numbers(content, (F.col("tag") == "p") & starts, "doc", "block_no")
    headed = subject_headings(numbered, among=F.col("tag") == "p")
    per = numbered.where("chapter_no > 0").groupBy("doc", "chapter_no").agg(F.array_sort(F.collect_list("block_no")).alias("own"))
    wanted = per.join(headed, "doc", "left").select("doc", "chapter_no", F.concat(F.array_compact(F.array("heading_no")), "own").alias("kept"))
    # all chapters of a document go to its file at once, so each file is read and shuffled once
    lists = wanted.groupBy("doc").agg(F.collect_list(F.struct(name.alias("name"), "kept")).alias("chapters"))
    both = _files(spark, path).join(lists, "doc").select("content", "chapters")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content, chapters in zip(b["content"], b["chapters"], strict=True):
                for c in chapters:
                    yield pd.DataFrame({"name": [c["name"]], "content": [chapter_document(bytes(content), set(map(int, c["kept"])))]})

    return both.mapInPandas(cut, FILES)


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote: (staged path, place)."""

    files: list[tuple[str, str]]


class _Writer(DataSourceWriter):
    def __init__(self, folder: str, overwrite: bool) -> None:
        self.folder, self.overwrite, self.job = folder, overwrite, uuid.uuid4().hex

    def _system(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.folder) if "://" in self.folder else (fs.LocalFileSystem(), os.path.abspath(self.folder))

    def _staged(self, base: str) -> str:
        return f"{base}/_staged-{self.job}"

    def write(self, rows: Iterator) -> WriterCommitMessage:
        system, base = self._system()
        done = []
        for r in rows:
            name = r["name"]
            if not name or name.startswith(("/", "_")) or ".." in name.split("/"):
                raise ValueError(f"{name!r} is no name below the folder")
            staged = f"{self._staged(base)}/{uuid.uuid4().hex}"  # two tries of one task write apart
            system.create_dir(self._staged(base), recursive=True)
            with system.open_output_stream(staged) as f:
                f.write(bytes(r["content"]))
            done.append((staged, f"{base}/{name}"))
        return Written(done)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow import fs

        system, base = self._system()
        moves = [f for m in messages if m is not None for f in m.files]
        places = [p for _, p in moves]
        if len(set(places)) < len(places):
            raise ValueError(f"{next(p for p in places if places.count(p) > 1)} is written twice")
        with ThreadPoolExecutor(16) as pool:
            if not self.overwrite and (there := [i.path for i in pool.map(lambda p: system.get_file_info(p), places) if i.type != fs.FileType.NotFound]):
                raise FileExistsError(there[0])
            for folder in {p.rpartition("/")[0] for p in places}:
                system.create_dir(folder, recursive=True)
            list(pool.map(lambda move: system.move(*move), moves))
        self._clear(system, base)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clear(*self._system())

    def _clear(self, system, base: str) -> None:
        from pyarrow import fs

        if system.get_file_info(self._staged(base)).type != fs.FileType.NotFound:
            system.delete_dir(self._staged(base))


class BinaryFiles(DataSource):
    """Rows (name, content) as files below ``path``, in place all together or not at all."""

    @classmethod
    def name(cls) -> str:
        return "binary_files"

    def schema(self) -> str:
        return FILES

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"], self.options.get("replace") == "true")


def write_documents(rows: DataFrame, folder: str, overwrite: bool = False) -> None:
    """Write (name, content) rows below ``folder``."""
    rows.sparkSession.dataSource.register(BinaryFiles)
    rows.write.format("binary_files").option("path", folder).option("replace", str(overwrite).lower()).mode("append").save()
