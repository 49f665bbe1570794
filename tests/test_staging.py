"""Staged tables, append-only reports, invalidation in tasks."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from corpusprep.functions.identity import artifact_sha256
from corpusprep.operators import manifests
from corpusprep.sinks import artifacts, run_log, staging


def table(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x int")


def failing(spark):
    @F.pandas_udf("int")
    def broken(s):
        raise RuntimeError("no more disk")

    return table(spark, 1).select(broken("x").alias("x"))


def seen(spark, folder, *names):
    return {n: sorted(r.x for r in staging.read(spark, folder, n).collect()) for n in names}


def test_tables_become_visible_together(spark, tmp_path):
    folder = str(tmp_path / "out")
    assert staging.publish_together({"chapters": table(spark, 1), "manifest": table(spark, 10)}, folder, "run1") == 1
    before = staging.read(spark, folder, "chapters")
    with pytest.raises(Exception, match="no more disk"):  # the first table is written, the second is not
        staging.publish_together({"chapters": table(spark, 2), "manifest": failing(spark)}, folder, "run2")
    assert os.path.exists(f"{folder}/runs/run2/chapters/_SUCCESS") and seen(spark, folder, "chapters", "manifest") == {"chapters": [1], "manifest": [10]}
    with pytest.raises(FileNotFoundError, match="manifest of run run2"):
        staging.promote(spark, folder, "run2", ["chapters", "manifest"], after=1)
    assert staging.publish_together({"chapters": table(spark, 2), "manifest": table(spark, 20)}, folder, "run2") == 2
    assert seen(spark, folder, "chapters", "manifest") == {"chapters": [2], "manifest": [20]}
    assert [r.x for r in before.collect()] == [1], "a plan made before keeps its run"
    assert staging.publish_together({"chunks": table(spark, 7)}, folder, "run3") == 3
    assert seen(spark, folder, "chapters", "manifest", "chunks") == {"chapters": [2], "manifest": [20], "chunks": [7]}, "what a run did not write stays"
    assert staging.vacuum(spark, folder) == ["run1"] and seen(spark, folder, "chunks") == {"chunks": [7]}
    assert not [f for f in os.listdir(folder) if f.startswith(staging.POINTER) and f != staging.POINTER]


def test_promotion_repeats_and_refuses_to_undo(spark, tmp_path):
    folder = str(tmp_path / "out")
    a, b = (staging.stage({"t": table(spark, k)}, folder, f"run{k}") for k in (1, 2))
    assert staging.promote(spark, folder, "run1", ["t"], a) == 1 == staging.promote(spark, folder, "run1", ["t"], a)
    with pytest.raises(RuntimeError, match="run1 was promoted"):
        staging.promote(spark, folder, "run2", ["t"], b)
    assert staging.promote(spark, folder, "run2", ["t"], staging.stage({"t": table(spark, 2)}, folder, "run2"), in_place=True) == 2
    assert seen(spark, folder, "t") == {"t": [2]} and staging.current(spark, str(tmp_path / "none"))["version"] == 0
    with pytest.raises(FileNotFoundError, match="no current table"):
        staging.read(spark, folder, "other")


def test_reports_are_appended_once(spark, tmp_path):
    log = str(tmp_path / "log")
    chapters = spark.createDataFrame([(1, 5, ["a"], None), (2, 0, [], {"aps": 1})], "chapter_no int, word_count int, automated_tags array<string>, converter_counts map<string,bigint>")
    audit = manifests.chapter_audit(chapters, spark.createDataFrame([(1,)], "chapter_no int"))
    t = "2024-01-01 00:00:00"
    report = run_log.job_row(spark, "prep-subject", {"subject_code": "S1"}, {"min_chars": "600"}, t).unionByName(run_log.chapter_rows(audit)).unionByName(run_log.run_row(audit, "prep-subject", t, "2024-01-01 00:01:00"))
    report = report.unionByName(run_log.publish_rows(artifacts.publication_status(spark, "prep-subject", ["chapters", "manifest"], ["chapters"])))
    for run, batch in (("2024-01", "0"), ("2024-01", "0"), ("2024-02", "0"), ("2024-02", "1"), ("2024-02", "1")):
        run_log.append(report, log, run, batch)
    got = run_log.read(spark, log)
    assert {(r.run_id, r.batch_id): r["count"] for r in got.groupBy("run_id", "batch_id").count().collect()} == {("2024-01", "0"): 7, ("2024-02", "0"): 7, ("2024-02", "1"): 7}
    rows = {(r.kind, r.name): r for r in got.where("run_id = '2024-01'").collect()}
    assert rows["job", "prep-subject"].notes == ["audit_schema_version: 1.0.0", "subject_code: S1", "min_chars: 600"]
    assert (rows["chapter", "2"].status, rows["chapter", "2"].notes) == ("not_published", ["The chapter was not published.", "The chapter has no words.", "No marker was found."])
    assert (rows["run", "prep-subject"].status, rows["run", "prep-subject"].counters) == ("partial", {"chapters": 2, "published": 1, "words": 5})
    assert {n: rows["publish", n].status for n in ("full_subject", "chapters", "manifest")} == {"full_subject": "not_asked", "chapters": "written", "manifest": "not_written"}
    told = {r.run_id: r for r in run_log.report_documents(got).collect()}
    assert json.loads(told["2024-01"].json)["rows"][1]["counters"] == {"chapters": 2, "published": 1, "words": 5} and len(json.loads(told["2024-02"].json)["rows"]) == 14
    assert told["2024-01"].markdown.startswith("# Run 2024-01\n\n- job prep-subject: started (settings 1)\n  - audit_schema_version: 1.0.0\n") and "- chapter 2: not_published (words 0)\n  - The chapter was not published.\n" in told["2024-01"].markdown
    with pytest.raises(ValueError, match="without slashes"):
        run_log.append(report, log, "a/b", "0")


def test_invalidation_of_many_subjects(spark, tmp_path):
    path, report = str(tmp_path / "chunks"), str(tmp_path / "report")
    spark.range(3000).select(F.format_string("S%04d", "id").alias("subject_code"), "id").repartition(4, "subject_code").write.partitionBy("subject_code").parquet(path)
    asked = spark.range(10_000).select(F.format_string("S%04d", F.col("id") + 100).alias("s"))
    assert artifacts.drop_subjects(spark, path, asked.union(asked.limit(3)), report=report) == 2900
    assert spark.read.parquet(report).count() == 10_000 and spark.read.parquet(path).select("subject_code").distinct().count() == 100
    assert artifacts.drop_subjects(spark, path, asked) == 0 and artifacts.drop_subjects(spark, path, ["S0007", "none"]) == 1


def test_names_of_partitions(spark, tmp_path):
    odd = ["a b", "x/y", "50%", "q=1", "é:", "[z]", "tab\t", "a'b\"", "{c}", "~^"]
    spark.createDataFrame([(s,) for s in odd], "subject_code string").withColumn("x", F.lit(1)).write.partitionBy("subject_code").parquet(str(tmp_path / "t"))
    assert {f.partition("=")[2] for f in os.listdir(tmp_path / "t") if "=" in f} == {artifacts.escaped(s) for s in odd}
    assert artifacts.drop_subjects(spark, str(tmp_path / "t"), odd) == len(odd)


def test_chapter_texts_end_in_a_newline(spark, tmp_path):
    df = spark.createDataFrame([(1, "one"), (2, None)], "n int, text string")
    artifacts.chapter_text_artifacts(df, str(tmp_path / "t"), F.format_string("%03d.txt", "n"), F.col("text"))
    assert (tmp_path / "t" / "001.txt").read_bytes() == b"one\n" and (tmp_path / "t" / "002.txt").read_bytes() == b"\n"
    assert df.where("n = 1").select(artifact_sha256(F.col("text"))).first()[0] == hashlib.sha256(b"one\n").hexdigest()
