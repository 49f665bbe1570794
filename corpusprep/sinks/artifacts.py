"""Sinks: one artifact per key, scoped overwrite, invalidation, exports.

Parquet tables, partitioned by subject, are the form that other jobs read. Files named per artifact are an export: each task
writes those of its rows through the file system that the path names.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tables that a command owns, and those made from them, which its overwrite makes stale.
OWNED = {"prep-subject": ("full_subject", "chapters", "manifest"), "generate-chunks": ("chunks", "chunk_manifest")}
DERIVED = {"prep-subject": ("chunks", "chunk_manifest"), "generate-chunks": ()}


def json_artifact(record: Column) -> Column:
    """JSON text with an indent of two, other letters kept, and a final newline."""

    @F.pandas_udf("string")
    def pretty(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield s.map(lambda t: None if t is None else json.dumps(json.loads(t), ensure_ascii=False, indent=2) + "\n")

    return pretty(F.to_json(record, {"ignoreNullFields": "false"}))


def write_files(rows: DataFrame, folder: str, name: Column, content: Column, overwrite: bool = False) -> None:
    """One file per row, in the file system that ``folder`` names (hdfs://, s3://, gs://, file:// or a plain path that all executors
    share). Without ``overwrite`` a file that is there is an error."""

    def write(batch: Iterator) -> None:
        import os

        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), os.path.abspath(folder))
        for r in batch:
            path = f"{base}/{r['_name']}"
            if not overwrite and system.get_file_info(path).type != fs.FileType.NotFound:
                raise FileExistsError(path)
            system.create_dir(path.rpartition("/")[0], recursive=True)
            part = f"{path}.{os.getpid()}.part"  # a task that runs again leaves whole files only
            with system.open_output_stream(part) as f:
                f.write(bytes(r["_content"]))
            system.move(part, path)

    rows.select(name.alias("_name"), F.encode(content, "UTF-8").alias("_content")).foreachPartition(write)


def chapter_text_artifacts(chapters: DataFrame, folder: str, name: Column, text: Column, overwrite: bool = False) -> None:
    """Chapter texts as files that end in one newline; ``identity.artifact_sha256`` of the text is the hash of such a file."""
    write_files(chapters, folder, name, F.concat(F.coalesce(text, F.lit("")), F.lit("\n")), overwrite)


def write_table(rows: DataFrame, path: str, subject_col: str = "subject_code", overwrite: bool = False) -> None:
    """A table partitioned by subject. Without ``overwrite`` subjects that are there already are an error; with it their partitions
    alone are replaced."""
    spark = rows.sparkSession
    present = _subjects(spark, path, subject_col)
    if present is not None and not overwrite:
        clash = [r[0] for r in rows.select(subject_col).distinct().join(present, subject_col, "left_semi").limit(10).collect()]
        if clash:
            raise FileExistsError(f"{path} has {', '.join(map(str, clash))} already")
    if present is None:
        rows.write.partitionBy(subject_col).parquet(path)
    else:
        mode = "overwrite" if overwrite else "append"
        rows.write.option("partitionOverwriteMode", "dynamic").partitionBy(subject_col).mode(mode).parquet(path)


def _subjects(spark: SparkSession, path: str, subject_col: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path).select(F.col(subject_col).cast("string").alias(subject_col)).distinct()
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


DROPPED = "subject string, was_there boolean"


def drop_subjects(spark: SparkSession, path: str, subjects: list[str] | DataFrame, subject_col: str = "subject_code", report: str | None = None, parallel: int = 32) -> int:
    """Delete the partitions of subjects, in tasks: subjects (a list, or a DataFrame of one column) are dealt over ``parallel`` of them, each of which
    deletes through the file system that ``path`` names. Deleting twice is deleting once, so a task may run again. Returns how many were
    there; ``report`` is a folder for one row for each subject (subject, was_there). Bounded: tasks return one row for each partition."""
    listed = spark.createDataFrame([(s,) for s in subjects], "subject string") if isinstance(subjects, list) else subjects.select(F.col(subjects.columns[0]).cast("string").alias("subject"))

    def delete(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), os.path.abspath(path))
        for b in batches:
            there = []
            for s in b["subject"]:
                folder = f"{base}/{subject_col}={escaped(s)}"
                known = system.get_file_info(folder).type != fs.FileType.NotFound
                if known:
                    system.delete_dir(folder)
                there.append(known)
            yield pd.DataFrame({"subject": b["subject"], "was_there": there})

    done = listed.where(F.col("subject").isNotNull()).distinct().repartition(parallel, "subject").mapInPandas(delete, DROPPED)
    if report is not None:
        done.write.mode("overwrite").parquet(report)  # the job runs once: a second run would tell that nothing was there
        done = spark.read.schema(DROPPED).parquet(report)
    return done.agg(F.count_if("was_there")).first()[0]


def escaped(value: str) -> str:
    """A value as Spark spells it in the name of a partition's folder."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 or c in "\"#%'*/:=?\\{[]^" else c for c in value) or "__HIVE_DEFAULT_PARTITION__"


def publish(tables: dict[str, DataFrame], folder: str, command: str, overwrite: bool = False, subject_col: str = "subject_code", legacy: tuple[str, ...] = ()) -> list[str]:
    """Write what ``command`` owns, in its order, and drop what was derived from it where it is overwritten. Without ``overwrite`` nothing
    is written if any table has one of the subjects already, or a table of an older layout (``legacy``) is there. Stops at the first
    failure; returns the tables written (see ``publication_status``)."""
    extra = set(tables) - set(OWNED[command])
    if extra:
        raise ValueError(f"{command} does not own {', '.join(sorted(extra))}")
    spark, done = next(iter(tables.values())).sparkSession if tables else None, []
    if not overwrite:  # all is looked at before anything is written
        for name in (n for n in OWNED[command] if n in tables):
            present = _subjects(spark, f"{folder}/{name}", subject_col)
            clash = [] if present is None else [str(r[0]) for r in tables[name].select(F.col(subject_col).cast("string").alias(subject_col)).distinct().join(present, subject_col, "left_semi").limit(10).collect()]
            if clash:
                raise FileExistsError(f"{folder}/{name} has {', '.join(clash)} already")
        for name in legacy:
            if tables and _subjects(spark, f"{folder}/{name}", subject_col) is not None:
                raise FileExistsError(f"{folder}/{name} was written in an older layout; overwrite to replace it")
    for name in OWNED[command]:
        if name in tables:
            write_table(tables[name], f"{folder}/{name}", subject_col, overwrite)
            done.append(name)
    if overwrite and done:
        subjects = reduce(DataFrame.unionByName, (tables[name].select(F.col(subject_col).cast("string").alias("subject")) for name in done))
        for name in DERIVED[command]:
            drop_subjects(next(iter(tables.values())).sparkSession, f"{folder}/{name}", subjects, subject_col)
    return done


def publication_status(spark: SparkSession, command: str, tables: list[str], done: list[str]) -> DataFrame:
    """What became of each table of a publication, in its order: position, name, status (written, not_written, not_asked)."""
    rows = [(i, n, "written" if n in done else "not_written" if n in tables else "not_asked") for i, n in enumerate(OWNED[command])]
    return spark.createDataFrame(rows, "position int, name string, status string")


def export_csv(rows: DataFrame, path: str, columns: list[str], required: list[str], order_by: list[str] | None = None, name: str | None = None) -> None:
    """One file of fixed columns in the folder ``path``, called ``name`` if that is given: rows without a required value left
    out, in the order of ``order_by`` (all columns if none is given), CRLF, quotes where needed. An export is read by people or sheets, so one task writes it."""
    from ..functions.text import is_blank

    kept = rows.select(*[F.col(f"`{c}`") for c in columns])
    for c in required:
        kept = kept.where(~is_blank(F.col(f"`{c}`")))
    kept = kept.orderBy(*[F.col(f"`{c}`") for c in order_by or columns]).coalesce(1)
    kept.write.mode("overwrite").option("header", True).option("lineSep", "\r\n").option("escape", '"').option("emptyValue", "").csv(path)
    if name is not None:
        spark = rows.sparkSession
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        system = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        part = next(s.getPath() for s in system.listStatus(at(path)) if s.getPath().getName().startswith("part-"))
        system.rename(part, at(f"{path}/{name}"))


def markdown_chunks(chunks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """A Markdown listing of each document's chunks."""
    part = F.format_string("## Chunk %d\n\n- sentences: %d\n- characters: %d\n- span: %d-%d\n\n%s", "index", "sentence_count", "char_count", "start_char", "end_char", "text")
    lists = chunks.select(id_col, "index", part.alias("_p")).groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("index", "_p"))).alias("_l"))
    return lists.select(id_col, F.concat(F.array_join(F.transform("_l", lambda s: s["_p"]), "\n\n"), F.lit("\n")).alias("markdown"))


def chunk_artifacts(chunks: DataFrame, id_col: str = "doc_id", version: str = "2.0.0") -> DataFrame:
    """The nested chunk artifact of each document."""
    fields = [c for c in chunks.columns if c != id_col]
    lists = chunks.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("chunks"))
    return lists.select(id_col, F.struct(F.lit(version).alias("schema_version"), F.size("chunks").alias("chunk_count"), "chunks").alias("artifact"))
