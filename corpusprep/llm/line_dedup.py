"""Line dedup: lines found in many documents go from all of them (native).

Hashes of the line keys are dealt by range with (document, position) as the secondary sort, so a line
that a third of all documents hold spreads over many tasks. Each (line, document) pair is met once, as
its first occurrence; frequent lines come from counting these. What returns to a document is not text
but its keep bitmap, run-length coded.

Null or empty text is one empty line. A line whose key is shorter than ``min_chars`` always stays.
Rows that repeat both id and text count as one document and all come back; rows that share only the id
are documents of their own. Null ids are an id like any other. Columns that clash with working names are
left as they are, since the working columns are made apart and joined back; an input column named like one that is
made (n_lines, n_dropped, kept) is replaced. A line found in just ``min_docs`` documents goes. An empty table gives an
empty table. A very long text is one array of lines in one task; its time grows with its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, ascii_lower, let, materialize, partitions


#: Ways in which the lines of one key are dealt out.
PARTS = 16


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Per document that loses a line: ``_id``, ``_tx`` (hash of its text), ``n_dropped`` and ``keep``, the runs
    (start, len) of lines that stay."""
    n = partitions(docs.sparkSession)
    lines = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_tx"), _lines(F.col(text_col)).alias("_lines"))
    keys = lines.select("_id", "_tx", F.size("_lines").alias("_n"), F.posexplode("_lines").alias("pos", "line")).withColumn("key", ascii_lower(F.btrim("line", F.lit(ASCII_SPACE))))
    # two hashes with different seeds: 96 bits name a line without carrying it
    hashed = keys.where(F.char_length("key") >= min_chars).select(F.xxhash64("key").alias("h"), F.hash("key").alias("h2"), "_id", "_tx", "_n", "pos")
    ranged = hashed.repartitionByRange(n, "h", "h2", "_id", "_tx").sortWithinPartitions("h", "h2", "_id", "_tx", "pos")
    firsts = materialize(ranged.groupBy("h", "h2", "_id", "_tx").agg(F.max("_n").alias("_n"), F.array_distinct(F.collect_list("pos")).alias("at")))
    frequent = firsts.groupBy("h", "h2").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") >= min_docs).select("h", "h2")
    # a line of a third of all documents is spread by document, and the frequent lines stand in every part
    spread = firsts.withColumn("part", F.pmod(F.hash("_id", "_tx"), F.lit(PARTS)))
    everywhere = frequent.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    dropped = (
        spread.join(everywhere, ["h", "h2", "part"], "left_semi")
        .groupBy("_id", "_tx")
        .agg(F.max("_n").alias("_n"), F.sort_array(F.flatten(F.collect_list("at"))).alias("at"))
    )
    runs = F.transform(
        F.sequence(F.lit(0), F.size("at")),
        lambda i: F.struct(
            F.when(i == 0, 0).otherwise(F.get("at", i - 1) + 1).alias("start"),
            (F.coalesce(F.get("at", i), F.col("_n")) - F.when(i == 0, 0).otherwise(F.get("at", i - 1) + 1)).alias("len"),
        ),
    )
    return dropped.select("_id", "_tx", F.size("at").cast("long").alias("n_dropped"), F.filter(runs, lambda r: r["len"] > 0).alias("keep"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1, out_col: str = "kept") -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``out_col``, the lines that stay joined by newlines."""
    bitmaps = keep_bitmaps(docs, id_col, text_col, min_docs, min_chars).alias("bits")
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs[id_col].alias("_rid"), docs[text_col].alias("_rtext"))
    both = rows.join(bitmaps, F.col("_rid").eqNullSafe(F.col("bits._id")) & (F.xxhash64("_rtext") == F.col("bits._tx")), "left")
    lines = _lines(F.col("_rtext"))
    left = let(lines, lambda all_: F.flatten(F.transform("keep", lambda r: F.slice(all_, r["start"] + 1, r["len"]))))
    kept = F.when(F.col("keep").isNull(), F.coalesce("_rtext", F.lit(""))).otherwise(F.array_join(left, "\n"))
    made = {"n_lines": F.size(lines).cast("long"), "n_dropped": F.coalesce("n_dropped", F.lit(0)).cast("long"), out_col: kept}
    return both.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in made], *[v.alias(k) for k, v in made.items()])
