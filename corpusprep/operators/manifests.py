"""Manifests, cross-checks, selection, publication order and report rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import artifact_sha256, content_identity, identity_matches


def select_chapters(manifest: DataFrame, wanted: DataFrame, key: str = "chapter_no") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The chapters asked for, the numbers that are not there, and numbers that occur twice."""
    asked = wanted.select(key).distinct()
    twice = manifest.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key)
    return manifest.join(asked, key, "left_semi"), asked.join(manifest, key, "left_anti"), twice


def content_manifest(metadata: DataFrame) -> DataFrame:
    """Chapters of each subject in manifest order (number, then the reference's JSON): one row per subject with an array."""
    chapter = F.struct(
        F.col("document.chapter_number").alias("generated_chapter_number"), F.to_json("storage.artifacts.metadata").alias("_ref"), F.col("content_identity.content_key").alias("content_key"),
        F.col("content_identity.normalized_content_sha256").alias("normalized_content_sha256"), F.col("storage.artifacts.metadata").alias("metadata_artifact"), F.col("storage.artifacts.text").alias("text_artifact"),
    )
    subject = [F.col(f"document.{c}").alias(c) for c in ("category_code", "subject_code", "language")]
    lists = metadata.select(*subject, chapter.alias("c")).groupBy("category_code", "subject_code", "language").agg(F.array_sort(F.collect_list("c")).alias("chapters"))
    return lists.select(F.lit(1).alias("schema_version"), F.lit(1).alias("identity_contract_version"), F.struct("category_code", "subject_code", "language").alias("subject"), F.transform("chapters", lambda c: c.dropFields("_ref")).alias("chapters"))


def safe_relative(path: Column) -> Column:
    """A relative path that stays below its base."""
    return (path != "") & ~path.startswith("/") & ~path.contains("\\") & ~path.rlike(r"(^|/)\.\.(/|$)") & ~path.rlike(r"^[A-Za-z]:")


def cross_check(manifest: DataFrame, metadata: DataFrame, texts: DataFrame, namespace: str) -> DataFrame:
    """Manifest against metadata against text, before any costly step: one row per chapter of the manifest with the first rule that
    fails, or null. Frames are keyed by ``chapter_no``; ``texts`` has ``text``."""
    m = manifest.select("chapter_no", F.col("content_key").alias("m_key"), F.col("normalized_content_sha256").alias("m_sha"), F.col("text_path").alias("m_text_path"))
    d = metadata.select("chapter_no", "document", "content_identity", F.col("integrity.artifacts.text.value").alias("d_artifact"), F.col("storage.artifacts.text.path").alias("d_text_path"), F.lit(True).alias("d_there"))
    t = texts.select("chapter_no", "text", F.lit(True).alias("t_there"))
    rows = m.join(d, "chapter_no", "left").join(t, "chapter_no", "left")
    expected = content_identity(namespace, F.col("document.category_code"), F.col("document.subject_code"), F.col("document.language"), F.col("text"))
    rows = rows.withColumn("_expected", expected)
    problem = (
        F.when(F.col("d_there").isNull(), "metadata is missing").when(F.col("t_there").isNull(), "text is missing")
        .when(~F.col("document.chapter_number").cast("int").eqNullSafe(F.col("chapter_no").cast("int")), "chapter numbers differ")
        .when(~F.coalesce(safe_relative(F.col("m_text_path")), F.lit(False)), "text path leaves its base").when(~F.col("m_text_path").eqNullSafe(F.col("d_text_path")), "text references differ")
        .when(~F.col("d_artifact").eqNullSafe(artifact_sha256(F.col("text"))), "text checksum differs")
        .when(~identity_matches(F.col("content_identity"), F.col("_expected")), "content identity differs")
        .when(~F.col("m_key").eqNullSafe(F.col("content_identity.content_key")) | ~F.col("m_sha").eqNullSafe(F.col("content_identity.normalized_content_sha256")), "manifest identity differs")
    )
    return rows.select("chapter_no", problem.alias("problem"))


def require_consistent(checked: DataFrame) -> None:
    bad = checked.where(F.col("problem").isNotNull()).orderBy("chapter_no").limit(10).collect()
    if bad:
        raise ValueError("; ".join(f"chapter {r['chapter_no']}: {r['problem']}" for r in bad))


def publication_order(files: DataFrame, path_col: str = "path") -> DataFrame:
    """Adds ``group_rank``, ``stem``, ``suffix_rank`` and ``seq``-able order: full subject, chapters (by stem; docx, txt, json), manifest, reports, other."""
    p = F.col(path_col)
    name = F.element_at(F.split(p, "/"), -1)
    chapter = p.startswith("chapters/msword/") | p.startswith("chapters/text_and_metadata/")
    group = F.when(p.startswith("full_subject/"), 0).when(chapter, 1).when(p == "chapters/chapter_content_manifest.json", 2).when(p.startswith("run_reports/prep-subject/"), 3).otherwise(4)
    suffix = F.regexp_extract(name, r"(\.[^.]*)$", 1)
    stem = F.when(chapter, F.regexp_replace(name, r"\.[^.]*$", "")).otherwise(p)
    rank = F.when(chapter, F.when(suffix == ".docx", 0).when(suffix == ".txt", 1).when(suffix == ".json", 2).otherwise(99)).otherwise(0)
    return files.withColumns({"group_rank": group, "stem": stem, "suffix_rank": rank})


def artifact_counts(files: DataFrame, classes: list[tuple[str, str, str]], path_col: str = "path", by: tuple[str, ...] = ()) -> DataFrame:
    """Files of each class (name, prefix, suffix); a file counts for the first that fits it; ``total`` counts all."""
    p, kind = F.col(path_col), F.lit(None).cast("string")
    for name, prefix, suffix in reversed(classes):
        kind = F.when(p.startswith(prefix) & p.endswith(suffix), F.lit(name)).otherwise(kind)
    return files.withColumn("_k", kind).groupBy(*by).agg(*[F.count_if(F.col("_k") == n).alias(n) for n, _, _ in classes], F.count(F.lit(1)).alias("total"))


def chunk_totals(chunks: DataFrame, chapters_total: int | None = None) -> DataFrame:
    """Chapters with chunks, chunks, tokens and characters of a run."""
    return chunks.agg(F.countDistinct("doc_id").alias("chapters"), F.count(F.lit(1)).alias("chunks"), F.coalesce(F.sum("estimated_token_count"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("char_count"), F.lit(0)).alias("characters"))


def summary_chapters(chapters: DataFrame, tags: list[str], tags_col: str = "automated_tags", by: tuple[str, ...] = ()) -> DataFrame:
    """Chapters, and how many of them hold all ``tags``."""
    every = F.lit(True)
    for t in tags:
        every = every & F.coalesce(F.array_contains(tags_col, t), F.lit(False))
    return chapters.groupBy(*by).agg(F.count(F.lit(1)).alias("chapters"), F.count_if(every).alias("summary_chapters"))


def report_counters(errors: DataFrame, checks: DataFrame, counters: DataFrame) -> DataFrame:
    """One row for a report: ``errors`` (stage: artifact, preflight or plan) and planned conflicts together as ``conflicts``, checks (passed) by
    outcome, and the counters of ``plan_counters`` as they are."""
    e = errors.agg(F.count_if(F.col("stage").isin("artifact", "preflight", "plan")).alias("_errors"))
    c = checks.agg(F.count_if("passed").alias("preflight_passed"), F.count_if(~F.col("passed")).alias("preflight_failed"))
    one = counters.crossJoin(F.broadcast(e)).crossJoin(F.broadcast(c))  # three rows of one each
    return one.withColumn("conflicts", F.col("_errors") + F.col("conflict_count")).drop("_errors")


def require_unique(rows: DataFrame, keys: list[str]) -> None:
    """Raise if rows share their keys, naming ten at most."""
    twice = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy(*keys).limit(10).collect()
    if twice:
        raise ValueError("not unique: " + "; ".join(", ".join(f"{k}={r[k]}" for k in keys) for r in twice))


def chapter_audit(chapters: DataFrame, published: DataFrame, key: str = "chapter_no") -> DataFrame:
    """One row per chapter of the source: what became of it (published, not_published) and notes for an operator. ``chapters``: key, word_count,
    automated_tags, converter_counts (a map or null); ``published``: the keys that were written."""
    done = published.select(key).distinct().withColumn("_done", F.lit(True))
    rows = chapters.join(done, key, "left")
    told = notes([
        (F.col("_done").isNull(), "The chapter was not published."), (F.col("word_count") == 0, "The chapter has no words."),
        (F.size("automated_tags") == 0, "No marker was found."), (F.coalesce(F.size("converter_counts"), F.lit(0)) <= 0, "No text was converted."),
    ])
    return rows.select(*chapters.columns, F.when(F.col("_done"), "published").otherwise("not_published").alias("status"), told.alias("notes"))


def copies(rows: DataFrame, key: str, id_col: str = "doc_id") -> DataFrame:
    """Rows that share ``key`` with another: with the number of ``copies`` and ``first_id``, the smallest of theirs."""
    again = rows.groupBy(key).agg(F.count(F.lit(1)).alias("copies"), F.min(id_col).alias("first_id")).where("copies > 1")
    return rows.join(again, key)


def notes(conditions: list[tuple[Column, str]]) -> Column:
    """Messages whose condition holds, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(m)) for c, m in conditions]))
