"""Records assembled from columns: storage references, chapter metadata, chunk sets, their manifest and summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import artifact_sha256, content_identity, spaceless_sha256
from ..functions.text import marker_tags, text_stats
from ..schemas import CHAPTER_METADATA_VERSION, CHUNK_ARTIFACT_VERSION, MANIFEST_VERSION
from .chunking import ChunkConfig


def join_key(*parts: Column) -> Column:
    """Parts of an object's key, without slashes at their ends; parts of nothing else are left out."""
    trimmed = F.array(*[F.btrim(F.coalesce(p, F.lit("")), F.lit("/")) for p in parts])
    return F.array_join(F.filter(trimmed, lambda p: p != ""), "/")


def storage_reference(path: Column, bucket: str | None = None, prefix: str = "", url_base: str | None = None) -> Column:
    """Where an artifact lies: by its path, or with ``bucket`` by key (below ``prefix``) and, with ``url_base``, by URL."""
    none = F.lit(None).cast("string")
    if bucket is None:
        fields = {"backend": F.lit("local"), "path": path, "bucket": none, "key": none, "url": none}
    else:
        key = join_key(F.lit(prefix), path)
        fields = {"backend": F.lit("r2"), "path": none, "bucket": F.lit(bucket), "key": key, "url": F.concat(F.lit(url_base.rstrip("/") + "/"), key) if url_base else none}
    return F.struct(*[v.alias(k) for k, v in fields.items()])


def text_integrity(text: Column) -> Column:
    # fixed values: how an artifact's checksum is taken
    how = {"algorithm": "sha256", "encoding": "UTF-8", "line_endings": "LF", "scope": "artifact"}
    # end of fixed values
    value = F.struct(*[F.lit(v).alias(k) for k, v in how.items()], artifact_sha256(text).alias("value"))
    return F.struct(F.struct(value.alias("text")).alias("artifacts"))


def chapter_metadata(chapters: DataFrame, namespace: str, language: str = "hi-Deva", markers: list[str] | None = None, tags: list[str] | None = None, **where: str | None) -> DataFrame:
    """The metadata record of each chapter. ``chapters``: category_code, subject_code, title_slug, chapter_no, version, text, text_path,
    metadata_path and, if there is one, converter_counts. ``where``: bucket, prefix and url_base of ``storage_reference``."""
    text, name = F.col("text"), lambda p: F.element_at(F.split(p, "/"), -1)
    counts = F.col("converter_counts") if "converter_counts" in chapters.columns else F.lit(None).cast("map<string,bigint>")
    found = marker_tags(text, markers, tags or []) if markers else F.array().cast("array<string>")
    record = {
        "schema_version": F.lit(CHAPTER_METADATA_VERSION),
        "document": F.struct("category_code", "subject_code", "title_slug", F.format_string("%03d", F.col("chapter_no").cast("int")).alias("chapter_number"), "version", F.lit(language).alias("language")),
        "files": F.struct(name("text_path").alias("text_filename"), name("metadata_path").alias("metadata_filename")),
        "storage": F.struct(F.struct(storage_reference(F.col("text_path"), **where).alias("text"), storage_reference(F.col("metadata_path"), **where).alias("metadata")).alias("artifacts")),
        "conversion": F.struct(counts.alias("converter_counts")),
        "integrity": text_integrity(text),
        "content_identity": content_identity(namespace, F.col("category_code"), F.col("subject_code"), F.lit(language), text),
        "content_stats": text_stats(text),
        "automated_tags": found,
    }
    return chapters.select("chapter_no", *[v.alias(k) for k, v in record.items()])


def chunk_sets(docs: DataFrame, chunks: DataFrame, config: ChunkConfig, provenance: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One record per document that was chunked, without chunks too: parameters, provenance (provider, model, ...), checksums of
    the source and of the chunks together without white space, counts, and the chunks by index."""
    fields = [c for c in chunks.columns if c != id_col]
    lists = chunks.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("index", *[c for c in fields if c != "index"]))).alias("chunks"))
    kind = lists.schema["chunks"].dataType
    rows = docs.select(id_col, F.col(text_col).alias("_t")).join(lists, id_col, "left").withColumn("chunks", F.coalesce("chunks", F.array().cast(kind)))
    return rows.select(
        id_col, F.lit(CHUNK_ARTIFACT_VERSION).alias("schema_version"), F.struct(*[F.lit(v).alias(k) for k, v in provenance.items()]).alias("provenance"),
        F.struct(*[F.lit(getattr(config, k)).alias(k) for k in ("threshold_percentile", "min_chars", "window_size", "batch_size", "device")]).alias("parameters"),
        spaceless_sha256(F.coalesce("_t", F.lit(""))).alias("source_text_sha256"), spaceless_sha256(F.array_join(F.transform("chunks", lambda c: c["text"]), "")).alias("concatenated_chunks_sha256"),
        F.size("chunks").alias("chunk_count"), F.aggregate("chunks", F.lit(0).cast("long"), lambda a, c: a + c["estimated_token_count"]).alias("estimated_token_count"), "chunks",
    )


def chunk_manifest(sets: DataFrame, source_chapters: int, by: list[str], id_col: str = "doc_id") -> DataFrame:
    """One manifest per ``by`` (a subject's columns in ``sets``): counts of chapters, chunks and tokens, and the chapters by id. ``source_chapters``:
    how many chapters the source has; those not in ``sets`` were skipped."""
    chapter = F.struct(id_col, F.lit("succeeded").alias("status"), "chunk_count", "estimated_token_count", "source_text_sha256")
    rows = sets.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum("chunk_count").alias("c"), F.sum("estimated_token_count").alias("t"), F.array_sort(F.collect_list(chapter)).alias("chapters"))
    counts = {
        "total_chapter_count": F.lit(source_chapters).cast("long"), "processed_chapter_count": F.col("n"), "skipped_chapter_count": F.lit(source_chapters).cast("long") - F.col("n"),
        "failed_chapter_count": F.lit(0).cast("long"), "total_chunk_count": F.col("c"), "total_estimated_token_count": F.col("t"),
    }
    return rows.select(*by, F.lit(MANIFEST_VERSION).alias("schema_version"), F.struct(*[v.alias(k) for k, v in counts.items()]).alias("counts"), "chapters")


def folder_summary(sets: DataFrame, folder: Column, id_col: str = "doc_id") -> DataFrame:
    """One row per ``folder``: the parameters and what each file gave, by id."""
    each = F.struct(id_col, "chunk_count", "estimated_token_count", "source_text_sha256", "concatenated_chunks_sha256")
    return sets.groupBy(folder.alias("folder"), "provenance", "parameters").agg(F.array_sort(F.collect_list(each)).alias("files"))
