"""Append-only run reports, and the rows that go into them.

A log is a table partitioned by run and batch. A batch is appended once however often it repeats: it writes its own partition, dynamic
overwrite, with the same rows, and no other. So a repeated batch, a task that ran twice or a restarted run leaves one row
for each key, and what other runs have told is never touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.manifests import notes
from ..schemas import AUDIT_VERSION

LOG = "run_id string, batch_id string, kind string, name string, status string, started timestamp, ended timestamp, counters map<string,bigint>, notes array<string>"


def append(rows: DataFrame, path: str, run_id: str, batch_id: str) -> None:
    """Append ``rows`` as batch ``batch_id`` of run ``run_id``; repeated, it replaces itself."""
    for column, value in (("run_id", run_id), ("batch_id", batch_id)):
        if not value or "/" in value:
            raise ValueError(f"{column} is a name without slashes, not {value!r}")
    stamped = rows.withColumns({"run_id": F.lit(run_id), "batch_id": F.lit(batch_id)})
    stamped.write.option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "batch_id").mode("overwrite").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All reports of all runs; no type is guessed from the names of partitions."""
    return spark.read.schema(LOG).parquet(path)


def row(df: DataFrame, kind: str, name: Column, status: Column, counters: dict[str, Column], told: Column, started: Column | None = None, ended: Column | None = None) -> DataFrame:
    """Report rows of one kind (job, chapter, run, publish), one for each row of ``df``."""
    stamp = lambda c: (F.lit(None) if c is None else c).cast("timestamp")
    counts = F.map_from_arrays(F.array(*map(F.lit, counters)), F.array(*[c.cast("long") for c in counters.values()]))
    return df.select(F.lit(kind).alias("kind"), name.cast("string").alias("name"), status.alias("status"), stamp(started).alias("started"), stamp(ended).alias("ended"), counts.alias("counters"), told.alias("notes"))


def job_row(spark: SparkSession, command: str, subject: dict[str, str], settings: dict[str, str], started: str) -> DataFrame:
    """What was asked for: the command, the subject it is for and the settings that shaped it, as notes ``key: value``."""
    one = spark.createDataFrame([(started,)], "started string")
    told = F.array(*[F.lit(f"{k}: {v}") for k, v in {"audit_schema_version": AUDIT_VERSION, **subject, **settings}.items()])
    return row(one, "job", F.lit(command), F.lit("started"), {"settings": F.lit(len(settings))}, told, F.col("started"))


def chapter_rows(audit: DataFrame, key: str = "chapter_no") -> DataFrame:
    """``manifests.chapter_audit`` as report rows."""
    counters = {"words": F.coalesce("word_count", F.lit(0))} if "word_count" in audit.columns else {"chapters": F.lit(1)}
    return row(audit, "chapter", F.col(key), F.col("status"), counters, F.col("notes"))


def run_row(audit: DataFrame, command: str, started: str, ended: str) -> DataFrame:
    """How the run went over all chapters: completed, partial (some were published) or failed (none was)."""
    total = audit.agg(F.count(F.lit(1)).alias("chapters"), F.count_if(F.col("status") == "published").alias("published"), F.coalesce(F.sum("word_count"), F.lit(0)).alias("words"))
    status = F.when(F.col("published") == F.col("chapters"), "completed").when(F.col("published") > 0, "partial").otherwise("failed")
    told = notes([(F.col("chapters") == 0, "The source has no chapters."), (F.col("published") < F.col("chapters"), "Some chapters were not published; see their rows."), (F.col("words") == 0, "No words were found.")])
    return row(total, "run", F.lit(command), status, {c: F.col(c) for c in ("chapters", "published", "words")}, told, F.lit(started), F.lit(ended))


def publish_rows(status: DataFrame) -> DataFrame:
    """``artifacts.publication_status`` as report rows, one for each table."""
    told = notes([(F.col("status") == "not_written", "The table was asked for and not written.")])
    return row(status, "publish", F.col("name"), F.col("status"), {"position": F.col("position")}, told)


def report_documents(log: DataFrame) -> DataFrame:
    """One report for each run: ``run_id``, ``json`` (kinds in the order below, rows by name) and ``markdown``, the same to read."""
    place = F.array_position(F.array(*map(F.lit, ("job", "run", "publish", "chapter"))), F.col("kind"))
    fields = ("kind", "name", "status", "started", "ended", "counters", "notes")
    counted = F.array_join(F.transform(F.array_sort(F.map_entries("counters")), lambda e: F.concat(e["key"], F.lit(" "), e["value"].cast("string"))), ", ")
    line = F.concat(F.lit("- "), F.col("kind"), F.lit(" "), F.col("name"), F.lit(": "), F.col("status"), F.when(F.length(counted) > 0, F.concat(F.lit(" ("), counted, F.lit(")"))).otherwise(""), F.array_join(F.transform("notes", lambda n: F.concat(F.lit("\n  - "), n)), ""))
    entry = F.struct(place.alias("place"), F.col("name").alias("by"), F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("json"), line.alias("line"))
    per = log.groupBy("run_id").agg(F.array_sort(F.collect_list(entry)).alias("e"))
    joined = lambda name, sep: F.array_join(F.transform("e", lambda e: e[name]), sep)
    return per.select("run_id", F.concat(F.lit('{"run_id":'), F.to_json(F.array("run_id")).substr(F.lit(2), F.length(F.to_json(F.array("run_id"))) - 2), F.lit(',"rows":['), joined("json", ","), F.lit("]}")).alias("json"), F.concat(F.lit("# Run "), "run_id", F.lit("\n\n"), joined("line", "\n"), F.lit("\n")).alias("markdown"))
