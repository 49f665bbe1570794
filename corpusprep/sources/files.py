"""File sources: tabular files with record numbers, texts, JSON, listings, selection."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def csv_rows(text: str) -> list[list[str]]:
    """Rows of a CSV text. Fields may be of any length; Python's limit of 131,072 characters is the process's, so it is set where rows are read."""
    csv.field_size_limit(2**31 - 1)
    return list(csv.reader(io.StringIO(text, newline="")))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of each CSV file: path, row_number (the header is 1; by record, not by line), values (array). A record may hold
    newlines, so a file is read as a whole, by one task; files are read side by side."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for p, content in zip(b["path"], b["content"], strict=True):
                rows = csv_rows(bytes(content).decode("utf-8-sig"))
                for at in range(0, len(rows), 5000):
                    part = rows[at : at + 5000]
                    yield pd.DataFrame({"path": p, "row_number": range(at + 1, at + 1 + len(part)), "values": part})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, "path string, row_number long, values array<string>")


def split_header(records: DataFrame) -> tuple[list[str] | None, DataFrame]:
    """The header of one file's records, and its other records."""
    first = records.where("row_number = 1").select("values").limit(1).collect()
    return (list(first[0][0]) if first else None), records.where("row_number > 1")


def csv_dicts(spark: SparkSession, path: str) -> DataFrame:
    """Rows by the header's names; empty lines are skipped."""
    return spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True, encoding="UTF-8", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, inferSchema=False)


def text_files(spark: SparkSession, path: str) -> DataFrame:
    """Whole texts with their bytes: path, name, stem, content, text."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", name.alias("name"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), "content", F.decode("content", "UTF-8").alias("text"))


def select_files(files: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files whose name or stem is asked for (``wanted``: name), and the names that no file has."""
    asked = wanted.select(F.col("name").alias("_asked")).distinct()
    names = files.select(F.explode(F.array("name", "stem")).alias("_have")).distinct()
    by_name = files.join(asked, F.col("name") == F.col("_asked"), "left_semi")
    by_stem = files.join(asked, F.col("stem") == F.col("_asked"), "left_semi").join(asked, F.col("name") == F.col("_asked"), "left_anti")
    return by_name.unionByName(by_stem), asked.join(names, F.col("_asked") == F.col("_have"), "left_anti").select(F.col("_asked").alias("name"))


def json_files(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row per JSON file, with a fixed schema; what does not parse goes to ``_corrupt``."""
    return spark.read.schema(f"{schema}, _corrupt string").option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt").json(path).withColumn("source_path", F.input_file_name())


def manifest_files(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Manifests with the hash of their exact bytes: path, manifest_sha256, manifest."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.sha2("content", 256).alias("manifest_sha256"), F.from_json(F.decode("content", "UTF-8"), schema).alias("manifest"))


def manifest_chapters(manifests: DataFrame, subject: dict[str, str], version: int = 1) -> tuple[DataFrame, DataFrame]:
    """Chapters of each manifest (path, manifest_sha256 and the chapter's fields), and the issues (path, chapter, message) of its header
    and of its chapters: versions, subject, no chapter, numbers that are not three digits or repeat, identity fields that are missing."""
    m = F.col("manifest")
    wrong = F.lit(False)
    for k, v in subject.items():
        wrong = wrong | ~m["subject"][k].eqNullSafe(F.lit(v))
    chapters = manifests.where(m.isNotNull()).select("path", "manifest_sha256", F.inline(m["chapters"]))
    number = F.col("generated_chapter_number")
    head = F.array_compact(F.array(
        F.when(m.isNull(), "The manifest is malformed."), F.when(m.isNotNull() & ~m["schema_version"].eqNullSafe(F.lit(version)), f"Unsupported schema_version; expected {version}."),
        F.when(m.isNotNull() & ~m["identity_contract_version"].eqNullSafe(F.lit(version)), f"Unsupported identity_contract_version; expected {version}."),
        F.when(m.isNotNull() & wrong, "The subject is another one."), F.when(m.isNotNull() & (F.coalesce(F.size(m["chapters"]), F.lit(0)) <= 0), "The manifest has no chapters."),
    ))
    issues = manifests.select("path", F.lit(None).cast("string").alias("chapter"), F.explode(head).alias("message"))
    each = F.array_compact(F.array(F.when(~F.coalesce(number.rlike(r"\A[0-9]{3}\z"), F.lit(False)), "The chapter number is not three digits."), F.when(F.col("content_key").isNull() | F.col("normalized_content_sha256").isNull(), "Identity fields are missing.")))
    issues = issues.unionByName(chapters.select("path", number.alias("chapter"), F.explode(each).alias("message")))
    twice = chapters.groupBy("path", number.alias("chapter")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("path", "chapter", F.lit("The chapter number occurs twice.").alias("message"))
    return chapters, issues.unionByName(twice)


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Objects below a path of any file system that Spark reads: path, length, modificationTime. Contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", "length", "modificationTime")


def is_empty(spark: SparkSession, path: str) -> bool:
    """Whether nothing lies below ``path``; stops at the first object."""
    try:
        return not listing(spark, path).limit(1).collect()
    except Exception as e:  # noqa: BLE001  a path that is not there holds nothing
        if "PATH_NOT_FOUND" in str(e):
            return True
        raise
