"""Semantic chunks: windows of sentences, distances of neighbours, breaks, merged groups, chunks with spans.

All steps partition by document, so the sentences are dealt out once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identity import sha256_text, spaceless_sha256
from ..functions.text import is_blank, strip, word_count
from ..functions.vectors import cosine_distance
from .encoders import Encoder, hashing_encoder
from .sentences import sentence_spans


@dataclass(frozen=True)
class ChunkConfig:
    threshold_percentile: float = 80.0
    min_chars: int = 600
    window_size: int = 3
    batch_size: int = 16
    device: str = "auto"

    def __post_init__(self) -> None:
        if not 0 <= self.threshold_percentile <= 100:
            raise ValueError("threshold_percentile must lie between 0 and 100")
        if self.min_chars < 0:
            raise ValueError("min_chars must not be negative")
        if self.window_size < 1 or self.batch_size < 1:
            raise ValueError("window_size and batch_size must be 1 or more")
        if self.device not in ("auto", "cpu", "cuda", "mps"):
            raise ValueError(f"unknown device {self.device!r}")


def context_windows(sentences: DataFrame, window_size: int, id_col: str = "doc_id") -> DataFrame:
    """Adds ``window_text``: the sentence with window_size // 2 neighbours on either side."""
    r = window_size // 2
    around = Window.partitionBy(id_col).orderBy("source_index").rowsBetween(-r, r)
    return sentences.withColumn("window_text", F.array_join(F.collect_list("text").over(around), " "))


def adjacent_distance(rows: DataFrame, id_col: str, order_col: str, vector_col: str) -> DataFrame:
    """Adds ``distance`` to the row before; null on the first."""
    before = F.lag(vector_col).over(Window.partitionBy(id_col).orderBy(order_col))
    return rows.withColumn("distance", F.when(before.isNotNull(), cosine_distance(before, F.col(vector_col))))


def breakpoints(rows: DataFrame, percentile: float, id_col: str, order_col: str) -> DataFrame:
    """Adds ``threshold`` (per document, null without distances), ``is_break`` (at or above it) and ``group_no``."""
    whole = Window.partitionBy(id_col)
    rows = rows.withColumn("threshold", F.percentile("distance", F.lit(percentile / 100)).over(whole))
    rows = rows.withColumn("is_break", F.coalesce(F.col("distance") >= F.col("threshold"), F.lit(False)))
    running = whole.orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("group_no", F.sum(F.col("is_break").cast("int")).over(running).cast("int"))


def merge_small(groups: Column, min_chars: int, texts: bool = False) -> Column:
    """``groups``: array of (first, last, chars), chars being the length of the joined sentences, and with ``texts`` also (start, end, raw).
    Groups are gathered until they reach ``min_chars``; what is left at the end joins the last that did."""
    kind = f"struct<first:int,last:int,chars:int{',start:int,end:int,raw:string' if texts else ''}>"
    empty = F.expr(f"named_struct('done', cast(array() as array<{kind}>), 'open', cast(null as {kind}))")

    def plain(g: Column) -> Column:
        numbers = [g[c].cast("int").alias(c) for c in ("first", "last", "chars", *(("start", "end") if texts else ()))]
        return F.struct(*numbers, *([g["raw"].alias("raw")] if texts else []))

    if min_chars <= 0:
        return F.transform(groups, plain)

    def both(a: Column, b: Column) -> Column:
        joined = [a["first"].alias("first"), b["last"].cast("int").alias("last"), (a["chars"] + 1 + b["chars"]).cast("int").alias("chars")]
        if texts:
            joined += [a["start"].alias("start"), b["end"].cast("int").alias("end"), F.concat(a["raw"], b["raw"]).alias("raw")]
        return F.when(a.isNull(), plain(b)).otherwise(F.struct(*joined))

    def step(acc: Column, g: Column) -> Column:
        now = both(acc["open"], g)
        return F.when(now["chars"] >= min_chars, F.struct(F.concat(acc["done"], F.array(now)).alias("done"), F.lit(None).cast(kind).alias("open"))).otherwise(F.struct(acc["done"].alias("done"), now.alias("open")))

    def finish(acc: Column) -> Column:
        done, left = acc["done"], acc["open"]
        last = F.element_at(done, -1)
        return F.when(left.isNull(), done).when(F.size(done) == 0, F.array(left)).otherwise(F.concat(F.slice(done, 1, F.size(done) - 1), F.array(both(last, left))))

    return F.aggregate(groups, empty, step, finish)


def merged_groups(rows: DataFrame, min_chars: int, id_col: str = "doc_id") -> DataFrame:
    """From sentences with ``group_no``: one row per chunk, ``id_col``, index (from 1), first and last sentence."""
    per_group = rows.groupBy(id_col, "group_no").agg(F.min("source_index").alias("first"), F.max("source_index").alias("last"), (F.sum(F.char_length("text")) + F.count(F.lit(1)) - 1).cast("int").alias("chars"))
    lists = per_group.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("first", "last", "chars"))).alias("groups"))
    return lists.select(id_col, F.posexplode(merge_small(F.col("groups"), min_chars)).alias("_p", "g")).select(id_col, (F.col("_p") + 1).alias("index"), F.col("g.first").alias("start_sentence"), F.col("g.last").alias("end_sentence"))


def chunk_records(rows: DataFrame, min_chars: int, id_col: str = "doc_id", count_tokens=word_count) -> DataFrame:
    """Chunk records from sentences with ``group_no`` and ``piece``. The text of a chunk is the slice of the source, made of its sentences'
    pieces, which tile the source: so no document is read again, and its length costs no more than once."""
    pieces = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("source_index", "piece"))), lambda s: s["piece"]), "")
    per_group = rows.groupBy(id_col, "group_no").agg(
        F.min("source_index").alias("first"), F.max("source_index").alias("last"), (F.sum(F.char_length("text")) + F.count(F.lit(1)) - 1).cast("int").alias("chars"),
        F.min("start_char").alias("start"), F.max("end_char").alias("end"), pieces.alias("raw"),
    )
    lists = per_group.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("first", "last", "chars", "start", "end", "raw"))).alias("groups"))
    each = lists.select(id_col, F.posexplode(merge_small(F.col("groups"), min_chars, texts=True)).alias("_p", "g")).select(id_col, (F.col("_p") + 1).alias("index"), strip(F.col("g.raw")).alias("text"), "g")
    return each.select(
        id_col, "index", "text", (F.col("g.last") - F.col("g.first") + 1).alias("sentence_count"), F.char_length("text").alias("char_count"), count_tokens(F.col("text")).cast("int").alias("estimated_token_count"),
        F.col("g.first").alias("start_sentence"), F.col("g.last").alias("end_sentence"), F.col("g.start").alias("start_char"), F.col("g.end").alias("end_char"), sha256_text(F.col("text")).alias("chunk_text_sha256"),
    )


def semantic_chunks(docs: DataFrame, config: ChunkConfig = ChunkConfig(), encode: Encoder | None = None, id_col: str = "doc_id", text_col: str = "text", count_tokens=word_count) -> DataFrame:
    """Chunk records of each document, in one pass over it. No sentence, no chunk; one sentence, one chunk."""
    sentences = sentence_spans(docs, id_col, text_col, pieces_too=True)
    rows = context_windows(sentences, config.window_size, id_col).withColumn("_vector", (encode or hashing_encoder())(F.col("window_text")))
    rows = adjacent_distance(rows, id_col, "source_index", "_vector").drop("_vector", "window_text")
    return chunk_records(breakpoints(rows, config.threshold_percentile, id_col, "source_index"), config.min_chars, id_col, count_tokens)


def chunk_coverage(docs: DataFrame, chunks: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rules of each document's chunks against its source: ``hashes_equal``, ``contiguous``, ``in_bounds``,
    ``no_overlap``, ``gaps_blank``, ``slices_equal``, ``tail_blank`` and ``is_covered``, all of them."""
    order = Window.partitionBy(id_col).orderBy("index")
    joined = chunks.join(docs.select(id_col, F.col(text_col).alias("_source")), id_col)
    joined = joined.withColumn("_n", F.row_number().over(order)).withColumn("_last", F.coalesce(F.lag("end_char").over(order), F.lit(0)))
    gap = F.substring("_source", F.col("_last") + 1, F.greatest(F.col("start_char") - F.col("_last"), F.lit(0)))
    ruled = joined.groupBy(id_col).agg(
        F.bool_and(F.col("index") == F.col("_n")).alias("contiguous"),
        F.bool_and((F.col("start_char") >= 0) & (F.col("start_char") < F.col("end_char")) & (F.col("end_char") <= F.char_length("_source"))).alias("in_bounds"),
        F.bool_and(F.col("start_char") >= F.col("_last")).alias("no_overlap"),
        F.bool_and(is_blank(gap)).alias("gaps_blank"),
        F.bool_and(F.substring("_source", F.col("start_char") + 1, F.col("end_char") - F.col("start_char")) == F.col("text")).alias("slices_equal"),
        F.max("end_char").alias("_end"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("index", "text"))), lambda s: s["text"]), "").alias("_joined"),
    )
    rules = ["contiguous", "in_bounds", "no_overlap", "gaps_blank", "slices_equal"]
    both = docs.select(id_col, F.col(text_col).alias("_source")).join(ruled, id_col, "left")
    both = both.select(
        id_col, *[F.coalesce(c, F.lit(True)).alias(c) for c in rules],
        (spaceless_sha256(F.coalesce("_source", F.lit(""))) == spaceless_sha256(F.coalesce("_joined", F.lit("")))).alias("hashes_equal"),
        is_blank(F.substring("_source", F.coalesce("_end", F.lit(0)) + 1, F.char_length("_source"))).alias("tail_blank"),
    )
    every = F.col("hashes_equal") & F.col("tail_blank")
    for c in rules:
        every = every & F.col(c)
    return both.withColumn("is_covered", every)


def require_covered(coverage: DataFrame) -> None:
    """Raise before anything is written if any document's chunks do not cover it."""
    bad = [str(r[0]) for r in coverage.where(~F.col("is_covered")).limit(10).collect()]
    if bad:
        raise ValueError(f"chunks do not cover their source: {', '.join(bad)}")
