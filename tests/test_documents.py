import json
import zipfile

import pytest
from pyspark.sql import functions as F

from corpusprep.functions.identity import artifact_sha256, content_identity
from corpusprep.operators import chunking, documents, manifests, retrieval
from corpusprep.sinks import artifacts
from corpusprep.sources import cms, docx, files

W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
NAMESPACE = "4b3f0c9e-52d4-4c39-9f0a-0d5a7c1e8b21"


def run(text, font=None):
    fonts = f'<w:rPr><w:rFonts w:ascii="{font}"/></w:rPr>' if font else ""
    return f"<w:r>{fonts}<w:t>{text}</w:t></w:r>"


def para(*runs):
    return f"<w:p>{''.join(runs)}</w:p>"


def write(path, *body, extra=None):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{W}"><w:body>{"".join(body)}<w:sectPr/></w:body></w:document>')
        for name, xml in (extra or {}).items():
            z.writestr(name, xml)


@pytest.fixture
def folder(tmp_path):
    write(tmp_path / "a.docx", para(run("जय जय")), para(run("विषय one")), para(run("Chapter 1")), para(run("text  one")), f"<w:tbl><w:tr><w:tc>{para(run('in table'))}</w:tc></w:tr></w:tbl>", para(), para(run("Chapter 2")), para(run("two")),
          extra={"word/footnotes.xml": f'<w:footnotes xmlns:w="{W}">{para(run("note"))}</w:footnotes>', "word/styles.xml": "<x/>"})
    write(tmp_path / "b.docx", para(run("x", "APS-DV-Prakash"), run("y", "aps_dv"), run("plain"), run("z", "Shree-Dev-1"), run("v", "priyanka")), para(run("none")))
    (tmp_path / "bad.docx").write_bytes(b"no zip")
    return tmp_path


def test_chapters(spark, folder):
    b = docx.blocks(spark, str(folder / "a.docx"))
    got = documents.chapters(b, "Chapter ").orderBy("chapter_no").collect()
    assert [(r.chapter_no, r.heading, r.text) for r in got] == [(1, "विषय one", "विषय one\n\nChapter 1\n\ntext one"), (2, "विषय one", "विषय one\n\nChapter 2\n\ntwo")]
    assert documents.chapters(b, "^chapter [2]", regex=True, flags="i").count() == 1
    assert documents.chapters(b, "absent").count() == 0
    whole = documents.full_text(docx.paragraphs(spark, str(folder / "a.docx"))).first().text
    assert "in table" in whole and whole.endswith("note")


def test_fonts(spark, folder):
    groups = documents.font_groups(docx.runs(spark, str(folder / "b.docx")))
    got = documents.convert_groups(groups, {"aps": lambda c: F.concat(F.upper(c), F.lit(" ।")), "shreelipi": F.upper}).orderBy("first_run").collect()
    assert [(r.converter, r.text, r.converted) for r in got] == [("aps", "xy", "XY।"), ("shreelipi", "z", "Z"), ("aps", "v", "V।")]
    assert documents.converter_counts(groups).first().converter_counts == {"aps": 2, "shreelipi": 1}


def test_validity(spark, folder):
    assert {r.path.rpartition("/")[2]: r.ok for r in docx.validity(spark, str(folder)).collect()} == {"a.docx": True, "b.docx": True, "bad.docx": False}


def test_files(spark, tmp_path):
    for n in ("x.txt", "y.txt"):
        (tmp_path / n).write_text(n)
    found, missing = files.select_files(files.text_files(spark, str(tmp_path)), spark.createDataFrame([("x",), ("y.txt",), ("z",)], "name string"))
    assert sorted(r.text for r in found.collect()) == ["x.txt", "y.txt"] and [r.name for r in missing.collect()] == ["z"]
    assert files.is_empty(spark, str(tmp_path / "none")) and not files.is_empty(spark, str(tmp_path))


def chapter(no, text, **change):
    ref = {"backend": "local", "path": f"t/{no:03d}.txt", "bucket": None, "key": None, "url": None}
    return {"no": no, "text": text, "ref": ref} | change


def test_cross_check(spark):
    df = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "chapter_no int, text string")
    ids = df.withColumn("i", content_identity(NAMESPACE, F.lit("CAT001"), F.lit("SUB001"), F.lit("hi"), F.col("text"))).withColumn("a", artifact_sha256(F.col("text")))
    path = F.format_string("t/%03d.txt", "chapter_no")
    manifest = ids.select("chapter_no", F.col("i.content_key").alias("content_key"), F.col("i.normalized_content_sha256").alias("normalized_content_sha256"), F.when(F.col("chapter_no") == 3, F.lit("../x")).otherwise(path).alias("text_path"))
    meta = ids.select(
        "chapter_no", F.struct(F.lit("CAT001").alias("category_code"), F.lit("SUB001").alias("subject_code"), F.lit("hi").alias("language"), F.format_string("%03d", "chapter_no").alias("chapter_number")).alias("document"), F.col("i").alias("content_identity"),
        F.struct(F.struct(F.struct(F.col("a").alias("value")).alias("text")).alias("artifacts")).alias("integrity"), F.struct(F.struct(F.struct(path.alias("path")).alias("text"), F.struct(path.alias("path")).alias("metadata")).alias("artifacts")).alias("storage"),
    )
    texts = df.withColumn("text", F.when(F.col("chapter_no") == 2, F.lit("changed")).otherwise(F.col("text")))
    got = {r.chapter_no: r.problem for r in manifests.cross_check(manifest, meta, texts, NAMESPACE).collect()}
    assert got == {1: None, 2: "text checksum differs", 3: "text path leaves its base"}
    with pytest.raises(ValueError, match="chapter 2"):
        manifests.require_consistent(manifests.cross_check(manifest, meta, texts, NAMESPACE))
    kept, missing, twice = manifests.select_chapters(manifest.union(manifest.where("chapter_no = 1")), spark.createDataFrame([(1,), (9,)], "chapter_no int"))
    assert kept.count() == 2 and [r[0] for r in missing.collect()] == [9] and [r[0] for r in twice.collect()] == [1]
    built = manifests.content_manifest(meta).first()
    assert [c.generated_chapter_number for c in built.chapters] == ["001", "002", "003"]


def test_sinks(spark, tmp_path):
    docs = spark.createDataFrame([(1, "One. Two."), (2, "Three.")], "doc_id int, text string")
    chunks = chunking.semantic_chunks(docs).withColumn("subject_code", F.concat(F.lit("S"), F.col("doc_id").cast("string")))
    out = str(tmp_path / "out")
    assert artifacts.publish({"chunks": chunks}, out, "generate-chunks") == ["chunks"]
    with pytest.raises(FileExistsError):
        artifacts.publish({"chunks": chunks}, out, "generate-chunks")
    artifacts.publish({"chapters": docs.withColumn("subject_code", F.lit("S1"))}, out, "prep-subject", overwrite=True)
    assert {r.subject_code for r in spark.read.parquet(f"{out}/chunks").collect()} == {"S2"}  # what was made from S1 is stale
    with pytest.raises(ValueError, match="does not own"):
        artifacts.publish({"chunks": chunks}, out, "prep-subject")
    nested = artifacts.chunk_artifacts(chunks.drop("subject_code"))
    artifacts.write_files(nested, str(tmp_path / "json"), F.format_string("%d.json", "doc_id"), artifacts.json_artifact(F.col("artifact")))
    assert json.loads((tmp_path / "json" / "1.json").read_text())["chunk_count"] == 1
    artifacts.export_csv(spark.createDataFrame([("a", 'x "q"'), ("", "y")], "k string, v string"), str(tmp_path / "csv"), ["k", "v"], ["k"])
    text = next((tmp_path / "csv").glob("part-*.csv")).read_bytes()
    assert text == b'k,v\r\na,"x ""q"""\r\n'
    assert "## Chunk 1" in artifacts.markdown_chunks(chunks).orderBy("doc_id").first().markdown


class Memory:
    """A store of 250 records behind the paged interface."""

    def __init__(self, options):
        self.options = options

    def page(self, collection, query):
        rows = [{"documentId": f"d{i}", "attributes": {"code": f"C{i}"}} for i in range(250)]
        if (only := query.get("filters[documentId][$eq]")) is not None:
            rows = [r for r in rows if r["documentId"] == only]
        n = query["pagination[pageSize]"]
        return {"data": rows[(query["pagination[page]"] - 1) * n :][:n], "meta": {"pagination": {"total": len(rows)}}}


def test_content_store():
    reader = cms._Reader({"collection": "subjects", "transport": f"{__name__}:Memory"})
    assert len(reader.partitions()) == 3
    assert len([r for p in reader.partitions() for r in reader.read(p)]) == 250
    assert list(reader.pushFilters([cms.EqualTo(("document_id",), "d7")])) == [] and len(reader.partitions()) == 1
    assert next(reader.read(reader.partitions()[0]))[0] == "d7"


def test_top_k(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, embedding array<float>")
    c = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, [1.0, 1.0])], "chunk_id int, embedding array<float>")
    assert [(r.rank, r.chunk_id) for r in retrieval.top_k(q, c, 3).orderBy("rank").collect()] == [(1, 1), (2, 2), (3, 4)]
    again = retrieval.top_k(q, c, 3, rerank=lambda a, b: F.aggregate(b, F.lit(0.0), lambda s, x: s + x), keep=1)
    assert again.first().chunk_id == 2


def test_top_k_of_many_queries(spark):
    """Any number of queries is answered, each against all blocks."""
    q = spark.range(12_000).select(F.col("id").alias("query_id"), F.array(F.lit(1.0), F.col("id") % 7 - 3.0).alias("embedding"))
    c = spark.range(3000).select(F.col("id").alias("chunk_id"), F.array(F.lit(1.0), F.col("id") % 5 - 2.0).alias("embedding"))
    got = retrieval.top_k(q, c, 3).groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "chunk_id"))).alias("l")).collect()
    # the direction nearest to -3 and -2 is -2 (ids 0, 5, 10), and so on
    want = {a: [max(-2, min(2, a)) + 2 + 5 * i for i in range(3)] for a in range(-3, 4)}
    assert len(got) == 12_000 and all([x.chunk_id for x in r.l] == want[r.query_id % 7 - 3] for r in got)


def test_top_k_of_odd_vectors(spark):
    nan = float("nan")
    q = spark.createDataFrame([(1, [1.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0])], "query_id int, embedding array<double>")
    c = spark.createDataFrame([("a", [1.0, None]), ("b", [0.0, 0.0]), ("c", [-1.0, -1.0]), ("d", [nan, 1.0]), ("e", [2.0, 2.0]), ("f", [3.0]), ("g", None), ("h", [1.0, 1.0])], "chunk_id string, embedding array<double>")
    found = {}
    for r in retrieval.top_k(q, c, 6).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.chunk_id)
    assert found == {1: list("dehbca"), 2: list("abcdef"), 3: list("dbceha"), 4: list("fabcde")}


def test_publication_order(spark):
    paths = ["run_reports/prep-subject/r.json", "chapters/text_and_metadata/b.json", "chapters/msword/b.docx", "chapters/chapter_content_manifest.json", "full_subject/f.txt", "chapters/text_and_metadata/a.txt", "z"]
    df = manifests.publication_order(spark.createDataFrame([(p,) for p in paths], "path string"))
    got = [r.path for r in df.orderBy("group_rank", "stem", "suffix_rank", "path").collect()]
    assert got == [paths[4], paths[5], paths[2], paths[1], paths[3], paths[0], paths[6]]


def test_stream(spark, tmp_path):
    from corpusprep.streaming.incremental import chunk_stream

    spark.createDataFrame([(1, "One. Two.")], "doc_id long, text string").write.parquet(str(tmp_path / "in"))
    seen = []
    chunk_stream(spark, str(tmp_path / "in"), "doc_id long, text string", str(tmp_path / "check"), lambda rows, n: seen.extend(rows.collect())).awaitTermination(120)
    assert [r.text for r in seen] == ["One. Two."]
