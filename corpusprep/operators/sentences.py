"""Sentences with exact code-point spans, by SQL functions alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import WS, normalize_spaces

#: Pieces that tile a text: up to a run of terminators and one closing quote before white space or the end.
PIECE = rf"""(?s).*?[।!?.]+["'”’]?(?={WS}|\z)|(?s).+\z"""


def sentence_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pieces_too: bool = False) -> DataFrame:
    """One row per sentence: ``id_col``, source_index, start_char, end_char (exclusive), text with white space
    collapsed. Blank and null texts have none. ``pieces_too`` adds ``piece``, the sentence as it stands with the white space before it."""
    pieces = docs.select(F.col(id_col), F.posexplode(F.regexp_extract_all(F.col(text_col), F.lit(PIECE), 0)).alias("_at", "_piece"))
    before = Window.partitionBy(id_col).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumn("_from", F.coalesce(F.sum(F.char_length("_piece")).over(before), F.lit(0)))
    lead = F.char_length(F.regexp_extract("_piece", rf"\A{WS}*", 0))
    body = F.regexp_replace("_piece", rf"\A{WS}+|{WS}+\z", "")
    kept = placed.withColumn("start_char", (F.col("_from") + lead).cast("int")).withColumn("end_char", (F.col("start_char") + F.char_length(body)).cast("int")).where(F.col("end_char") > F.col("start_char"))
    number = F.row_number().over(Window.partitionBy(id_col).orderBy("_at")) - 1
    return kept.select(id_col, number.cast("int").alias("source_index"), "start_char", "end_char", normalize_spaces(F.col("_piece")).alias("text"), *([F.col("_piece").alias("piece")] if pieces_too else []))
