"""Records that are assembled, artifacts that are loaded, reports and sinks."""

import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from corpusprep.functions import text
from corpusprep.functions.identity import content_identity
from corpusprep.operators import assembly, chunking, documents, manifests, reconcile, records, rules
from corpusprep.sinks import artifacts
from corpusprep.sources import cms, files, seeds

NAMESPACE = "4b3f0c9e-52d4-4c39-9f0a-0d5a7c1e8b21"


def test_keys_and_references(spark):
    r = spark.createDataFrame([("/a/", "b/c.txt", None), ("", "x", "/")], "p string, q string, r string")
    assert [x[0] for x in r.select(assembly.join_key(F.col("p"), F.col("q"), F.col("r"))).collect()] == ["a/b/c.txt", "x"]
    one = r.limit(1).select(assembly.storage_reference(F.col("q"), "bk", "/pre/", "https://h/").alias("s"), assembly.storage_reference(F.col("q")).alias("l")).first()
    assert one.s.asDict() == {"backend": "r2", "path": None, "bucket": "bk", "key": "pre/b/c.txt", "url": "https://h/pre/b/c.txt"}
    assert one.l.asDict() == {"backend": "local", "path": "b/c.txt", "bucket": None, "key": None, "url": None}
    assert r.limit(1).select(assembly.storage_reference(F.col("q"), "bk").alias("s")).first().s.url is None


def test_chapter_metadata(spark):
    rows = spark.createDataFrame([("C", "S", "slug", 7, "v01.02", "two words café", "t/x.txt", "t/x.json", {"aps": 2})], "category_code string, subject_code string, title_slug string, chapter_no int, version string, text string, text_path string, metadata_path string, converter_counts map<string,bigint>")
    m = assembly.chapter_metadata(rows, NAMESPACE, markers=["café"], tags=["a", "b"], bucket="bk", prefix="p").first()
    assert m.document.chapter_number == "007" and m.files.text_filename == "x.txt" and m.conversion.converter_counts == {"aps": 2}
    assert m.storage.artifacts.metadata.key == "p/t/x.json" and m.automated_tags == ["a", "b"] and m.content_stats.word_count == 3
    assert m.integrity.artifacts.text.value == hashlib.sha256("two words café\n".encode()).hexdigest()
    assert m.content_identity == rows.select(content_identity(NAMESPACE, F.lit("C"), F.lit("S"), F.lit("hi-Deva"), F.col("text"))).first()[0]
    assert assembly.chapter_metadata(rows, NAMESPACE).first().automated_tags == []


def test_chunk_sets(spark):
    docs = spark.createDataFrame([(1, "One. Two three."), (2, " "), (3, "Four.")], "doc_id int, text string")
    config = chunking.ChunkConfig()
    sets = assembly.chunk_sets(docs, chunking.semantic_chunks(docs, config), config, {"provider": "hash", "model": "m"})
    got = {r.doc_id: r for r in sets.collect()}
    assert [got[i].chunk_count for i in (1, 2, 3)] == [1, 0, 1] and got[1].estimated_token_count == 3
    assert all(r.source_text_sha256 == r.concatenated_chunks_sha256 for r in got.values()) and got[1].parameters.min_chars == 600 and got[3].provenance.provider == "hash"
    whole = assembly.chunk_manifest(sets.withColumn("subject", F.lit("S")), 5, ["subject"]).first()
    assert whole.counts.asDict() == {"total_chapter_count": 5, "processed_chapter_count": 3, "skipped_chapter_count": 2, "failed_chapter_count": 0, "total_chunk_count": 2, "total_estimated_token_count": 4}
    assert [c.doc_id for c in whole.chapters] == [1, 2, 3]
    folders = assembly.folder_summary(sets, F.when(F.col("doc_id") < 3, "a").otherwise("b")).orderBy("folder").collect()
    assert [(r.folder, [f.doc_id for f in r.files]) for r in folders] == [("a", [1, 2]), ("b", [3])]


def seed(path, **change):
    record = {"schema_version": 1, "workflow": "category", "source": {"key": "categories", "label": "x"}, "strapi": {"collection_type": "category", "display_name": "Categories"}, "records": [{"category_code": "C1", "sort_order": 2}, {"category_code": "C2", "sort_order": None}]}
    path.write_text(json.dumps(record | change))
    return str(path)


def test_seed_artifacts(spark, tmp_path):
    schema = "category_code string, sort_order int"
    rows, problems = seeds.load(spark, seed(tmp_path / "a.json"), "category", schema)
    assert not problems and [(r.position, r.category_code, r.sort_order) for r in rows.orderBy("position").collect()] == [(0, "C1", 2), (1, "C2", None)]
    rows, problems = seeds.load(spark, seed(tmp_path / "b.json", workflow="subject"), "category", schema)
    assert rows is None and problems == ["category artifact: workflow is subject, expected category."]
    assert seeds.load(spark, seed(tmp_path / "c.json", schema_version=None), "category", schema)[1] == ["category artifact: schema_version is missing, expected 1."]
    assert seeds.load(spark, seed(tmp_path / "a.json"), "subject", schema)[1][0].endswith("expected subject.")
    (tmp_path / "bad.json").write_text("{")
    assert "not valid JSON" in seeds.load(spark, str(tmp_path / "bad.json"), "category", schema)[1][0]
    assert "not found" in seeds.load(spark, str(tmp_path / "none.json"), "category", schema)[1][0]
    assert seeds.load(spark, "x", "other", schema)[1][0].startswith("Unsupported ingest target: other.")
    got = seeds.routed(spark.createDataFrame([("subject",), ("zzz",), (None,)], "target string")).collect()
    assert [r.route and r.route.source_key for r in got] == ["subjects", None, None] and [bool(r.blocked) for r in got] == [False, True, True]


MANIFEST = "schema_version int, identity_contract_version int, subject struct<category_code:string,subject_code:string,language:string>, chapters array<struct<generated_chapter_number:string,content_key:string,normalized_content_sha256:string>>"


def test_manifests_of_files(spark, tmp_path):
    good = {"schema_version": 1, "identity_contract_version": 1, "subject": {"category_code": "C", "subject_code": "S", "language": "hi"}, "chapters": [{"generated_chapter_number": "001", "content_key": "k", "normalized_content_sha256": "h"}]}
    bad = good | {"schema_version": 2, "subject": {"category_code": "X"}, "chapters": [*good["chapters"] * 2, {"generated_chapter_number": "1"}]}
    for name, m in (("good", good), ("bad", bad), ("empty", good | {"chapters": []})):
        (tmp_path / f"{name}.json").write_text(json.dumps(m))
    read = files.manifest_files(spark, f"{tmp_path}/*.json", MANIFEST)
    assert {r.manifest_sha256 for r in read.collect()} >= {hashlib.sha256((tmp_path / "good.json").read_bytes()).hexdigest()}
    chapters, issues = files.manifest_chapters(read, good["subject"])
    assert chapters.count() == 4
    got = sorted((r.path.rpartition("/")[2], r.chapter or "", r.message) for r in issues.collect())
    assert got == [
        ("bad.json", "", "The subject is another one."), ("bad.json", "", "Unsupported schema_version; expected 1."), ("bad.json", "001", "The chapter number occurs twice."),
        ("bad.json", "1", "Identity fields are missing."), ("bad.json", "1", "The chapter number is not three digits."), ("empty.json", "", "The manifest has no chapters."),
    ]


def test_csv_and_json_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\r\n1,"x ""q""\nnext"\r\n\r\n2,\r\n')
    assert [(r.k, r.v) for r in files.csv_dicts(spark, str(tmp_path / "a.csv")).collect()] == [("1", 'x "q"\nnext'), ("2", None)]
    (tmp_path / "a.json").write_text('{"a": 1,\n "b": "x"}')
    (tmp_path / "b.json").write_text("{")
    got = {r.source_path.rpartition("/")[2]: (r.a, r.b, r._corrupt is not None) for r in files.json_files(spark, f"{tmp_path}/*.json", "a int, b string").collect()}
    assert got == {"a.json": (1, "x", False), "b.json": (None, None, True)}


def test_stamps_and_records(spark):
    at = spark.createDataFrame([(dt.datetime(2024, 5, 6, 7, 8, 9, tzinfo=dt.UTC),)], "t timestamp")
    assert tuple(at.select(text.utc_stamp(F.col("t")), text.utc_file_stamp(F.col("t"))).first()) == ("2024-05-06T07:08:09Z", "20240506T070809Z")
    row = {"code": " S1 ", "legacy_code": " ", "is_active": "TRUE", "sort_order": "1_0", "category_code": "C", "desired_status": "draft", "name_en": "n", "description_en": "", "name_hi-IN": "h", "description_hi-IN": " d", "from_date": "", "to_date": "2020", "prabodhan_count": " 4 "}
    got = records.subject_records(spark.createDataFrame([row])).first()
    assert (got.subject_code, got.legacy_code, got.is_active, got.sort_order, got.description_en, got.description_hi_IN, got.from_date, got.to_date, got.prabodhan_count) == ("S1", None, True, 10, None, "d", None, "2020", 4)
    assert records.glossary_records(spark.createDataFrame([("1", " T ", "term ", "def")], "`Sr No` string, `Term Code` string, Term string, Definition string")).first().asDict() == {"term_code": "T", "term": "term", "definition": "def"}


def test_reports(spark):
    issues = spark.createDataFrame([("error", 1), ("error", 2), ("warning", 1)], "severity string, row_number int")
    assert {r.severity: r.issues for r in rules.issue_counts(issues).collect()} == {"error": 2, "warning": 1}
    chunks = spark.createDataFrame([(1, 5, 30), (1, 6, 40), (2, 1, 2)], "doc_id int, estimated_token_count int, char_count int")
    assert tuple(manifests.chunk_totals(chunks).first()) == (2, 3, 12, 72)
    chapters = spark.createDataFrame([("a", 1, 5, ["x", "y"], {"aps": 1}), ("a", 2, 0, ["x"], None), ("b", 3, 1, [], {})], "s string, chapter_no int, word_count int, automated_tags array<string>, converter_counts map<string,bigint>")
    assert {r.s: (r.chapters, r.summary_chapters) for r in manifests.summary_chapters(chapters, ["x", "y"], by=("s",)).collect()} == {"a": (2, 1), "b": (1, 0)}
    audit = {r.chapter_no: (r.status, r.notes) for r in manifests.chapter_audit(chapters, chapters.where("chapter_no < 3").select("chapter_no")).collect()}
    assert audit[1] == ("published", []) and audit[2] == ("published", ["The chapter has no words.", "No text was converted."]) and audit[3][0] == "not_published" and len(audit[3][1]) == 3
    plan = spark.createDataFrame([("update", True, False), ("conflict", False, False)], "action string, create_localized boolean, update_localized boolean")
    r = manifests.report_counters(spark.createDataFrame([("artifact",), ("plan",), ("other",)], "stage string"), spark.createDataFrame([(True,), (False,), (True,)], "passed boolean"), reconcile.plan_counters(plan)).first()
    assert (r.conflicts, r.preflight_passed, r.preflight_failed, r.update_count, r.publish_actions) == (3, 2, 1, 1, 2)
    manifests.require_unique(chapters, ["chapter_no"])
    with pytest.raises(ValueError, match="s=a"):
        manifests.require_unique(chapters, ["s"])


def test_headings_count_all_blocks(spark):
    """The first eight blocks of the preface are looked at, tables among them."""
    rows = [("d", i, "tbl", "cell") for i in range(7)] + [("d", 7, "p", "a title"), ("d", 8, "p", "विषय too far down"), ("d", 9, "p", "Chapter 1"), ("d", 10, "p", "text")]
    got = documents.chapters(spark.createDataFrame(rows, "doc string, block_no int, tag string, text string"), "Chapter ").first()
    assert got.heading == "a title"


def test_converters_meet_their_own_rows(spark):
    groups = spark.createDataFrame([("d", "p", 1, 1, "aps", "x"), ("d", "p", 1, 2, "other", "y"), ("d", "p", 2, 1, "shreelipi", "z"), ("d", "p", 2, 2, None, "w")], "doc string, part string, para_no int, first_run int, converter string, text string")

    @F.pandas_udf("string")
    def only_x(s):
        import pandas as pd

        assert set(s) <= {"x"}
        return pd.Series([t.upper() for t in s])

    made = documents.convert_groups(groups, {"aps": only_x, "shreelipi": lambda c: F.concat(c, c)})
    assert {r.text: r.converted for r in made.collect()} == {"x": "X", "y": None, "z": "zz", "w": None}
    assert documents.converted_text(made.where("converted is not null")).first().text == "X\n\nzz"


def test_lookup(spark):
    rows, one, two = (spark.createDataFrame(x, "k int, v string") for x in ([(1, ""), (2, ""), (3, ""), (4, "")], [(1, "a"), (2, "b"), (2, "c")], [(2, "z"), (3, "y"), (1, "a")]))
    got = reconcile.lookup_with_fallback(rows.select("k"), (F.col("k"), one, "k", "v"), (F.col("k"), two, "k", "v")).collect()
    assert {r.k: (r.resolved, r.differs) for r in got} == {1: ("a", False), 2: ("b", True), 3: ("y", False), 4: ("", False)}


def test_publication(spark, tmp_path):
    rows, out = spark.createDataFrame([("S1", 1), ("S2", 2)], "subject_code string, x int"), str(tmp_path / "o")
    artifacts.publish({"manifest": rows}, out, "prep-subject")
    with pytest.raises(FileExistsError, match="manifest has S1"):  # found before full_subject is written
        artifacts.publish({"full_subject": rows, "manifest": rows.where("x = 1")}, out, "prep-subject")
    assert not (tmp_path / "o" / "full_subject").exists()
    rows.write.partitionBy("subject_code").parquet(f"{out}/old")
    with pytest.raises(FileExistsError, match="older layout"):
        artifacts.publish({"full_subject": rows}, out, "prep-subject", legacy=("old",))
    done = artifacts.publish({"full_subject": rows}, out, "prep-subject", overwrite=True, legacy=("old",))
    assert [r.status for r in artifacts.publication_status(spark, "prep-subject", ["full_subject", "chapters"], done).orderBy("position").collect()] == ["written", "not_written", "not_asked"]


def test_csv_export_is_one_file(spark, tmp_path):
    rows = spark.range(500).select(F.format_string("k%03d", 499 - F.col("id")).alias("k"), F.lit('x "q"').alias("v")).repartition(7)
    artifacts.export_csv(rows, str(tmp_path / "csv"), ["k", "v"], ["k"], name="out.csv")
    lines = (tmp_path / "csv" / "out.csv").read_bytes().decode().split("\r\n")
    assert lines[0] == "k,v" and lines[1] == 'k000,"x ""q"""' and len(lines) == 502 and lines[-1] == ""
    assert lines[1:-1] == sorted(lines[1:-1]) and not list((tmp_path / "csv").glob("part-*"))


class Store:
    """Records behind the paged interface; what is written is kept in a file."""

    def __init__(self, options):
        self.options = options

    def page(self, collection, query):
        rows = [{"documentId": f"d{i}", "attributes": {"code": f"C{i % 3}", "n": i}} for i in range(30)]
        if (only := query.get("filters[code][$eq]")) is not None:
            rows = [r for r in rows if r["attributes"]["code"] == only]
        n = query["pagination[pageSize]"]
        return {"data": rows[(query["pagination[page]"] - 1) * n :][:n], "meta": {"pagination": {"total": len(rows)}}}

    def write(self, verb, collection, document_id, locale, payload):
        with open(self.options["log"], "a") as f:
            f.write(json.dumps([verb, collection, document_id, locale, payload]) + "\n")


def test_content_store_pushes_any_field(spark, tmp_path):
    reader = cms._Reader({"collection": "subjects", "transport": f"{__name__}:Store", "fields": "code, n"})
    kept = list(reader.pushFilters([cms.EqualTo(("code",), "C1"), cms.EqualTo(("other",), 1)]))
    assert [f.attribute for f in kept] == [("other",)]
    got = [r for p in reader.partitions() for r in reader.read(p)]
    assert len(got) == 10 and got[0][3:] == ("C1", "1")
    assert cms.ContentStore({"fields": "code"}).schema() == "document_id string, position long, record string, `code` string"
    row = {"verb": "update", "document_id": "d1", "locale": "en", "payload": '{"a": 1}'}
    log = str(tmp_path / "log")
    for apply in ("false", "true"):
        cms._Writer({"collection": "subjects", "transport": f"{__name__}:Store", "log": log, "apply": apply}).write(iter([row]))
    with open(log) as f:
        assert [json.loads(x) for x in f] == [["update", "subjects", "d1", "en", {"a": 1}]]
