"""The corpus pipeline: toxic documents go, lines that many documents share go, one document of each
near-duplicate group stays, documents that hold benchmark passages go, and what is left is segmented.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All but the last return the columns of
``documents``; ``n_chars`` follows the text. Null and empty texts pass every stage (wordless documents are
near duplicates of each other, so one of them stays). An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm import decontaminate, line_dedup, pieces, simhash, toxicity
from corpusprep.llm.common import discard, materialize, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores 0.7 or more go. Labels of the held-out fold teach nothing."""
    labels = table(spark, sf_dir, "labels").where(toxicity.may_teach())
    return toxicity.reject(docs, toxicity.train(docs, labels)).select(*COLUMNS)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; the documents stay, with what is left of their text."""
    kept = line_dedup.line_dedup(docs)
    return kept.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.char_length("kept").cast("long").alias("n_chars"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return simhash.dedup(docs).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark item, or a shorter item whole, go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def segment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sampled pieces of each document, and whether they spell its text."""
    both = pieces.round_trip(docs.select(*COLUMNS))
    return both.select("doc_id", "lang", "source", "n_chars", F.size("pieces").cast("long").alias("n_pieces"), "pieces", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_common_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("sentencepiece", segment),
]

#: The first stage is a trained model, the third a connected-components search and the last a seeded
#: sampler: none of them is SQL. tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs)
            if before is not None:  # all that the next stage needs is written
                discard(before)
            before = docs
    return docs
