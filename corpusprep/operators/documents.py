"""Documents to chapters: segmentation by marked blocks, headings, font groups, texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import INVOCATION_MARKS, LECTURE_MARK, SUBJECT_MARK, normalize_spaces

# fixed values: parts of font names that tell the converter, in order of precedence
FONT_PATTERNS = {
    "aps": ("aps-dv", "aps dv", "aps_dv", "priyanka", "prakash"),
    "shreelipi": ("shreelipi", "shree-lipi", "shree lipi", "srilipi", "sri-lipi", "sri lipi", "shree-dev", "shreedev"),
}
# end of fixed values


def chapter_numbers(blocks: DataFrame, start: Column, doc_col: str = "doc", order_col: str = "block_no") -> DataFrame:
    """Adds ``chapter_no``: 0 before the first block that starts a chapter. Rows that ``start`` holds for open one."""
    running = Window.partitionBy(doc_col).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    return blocks.withColumn("chapter_no", F.sum(F.coalesce(start, F.lit(False)).cast("int")).over(running).cast("int"))


def subject_headings(blocks: DataFrame, doc_col: str = "doc", order_col: str = "block_no", first: int = 8, among: Column | None = None, subject_mark: str = SUBJECT_MARK, skip: tuple[str, ...] = (*INVOCATION_MARKS, LECTURE_MARK)) -> DataFrame:
    """At most one ``heading`` per document, with its place ``heading_no``: of the first preface blocks the first that holds the subject mark, else the first that is
    neither invocation nor lecture mark. ``blocks`` have ``chapter_no``; all of them are counted, ``among`` tells which may be headings."""
    order = Window.partitionBy(doc_col).orderBy(order_col)
    top = blocks.where(F.col("chapter_no") == 0).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= first)
    top = top if among is None else top.where(among)
    text = normalize_spaces(F.col("text"))
    skipped = F.lit(False)
    for m in skip:
        skipped = skipped | text.contains(m)
    ranked = top.withColumn("_t", text).where(F.col("_t") != "").withColumn("_rank", F.when(F.col("_t").contains(subject_mark), 0).when(~skipped, 1)).where(F.col("_rank").isNotNull())
    pick = Window.partitionBy(doc_col).orderBy("_rank", order_col)
    return ranked.withColumn("_n", F.row_number().over(pick)).where("_n = 1").select(doc_col, F.col("_t").alias("heading"), F.col(order_col).alias("heading_no"))


def ordered_text(rows: DataFrame, by: list[str], order_col: str, text: Column, separator: str) -> DataFrame:
    """Texts that are not blank, joined in order."""
    kept = rows.withColumn("_t", text).where(F.col("_t") != "")
    lists = kept.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(order_col, "_t"))).alias("_l"))
    return lists.select(*by, F.array_join(F.transform("_l", lambda s: s["_t"]), separator).alias("text"))


def chapters(blocks: DataFrame, pattern: str, regex: bool = False, flags: str = "", doc_col: str = "doc", order_col: str = "block_no") -> DataFrame:
    """Chapters of each document, from blocks (doc, block_no, tag, text): doc, chapter_no (from 1), heading, text. Only paragraphs
    start chapters and give text; section properties are no content. Documents without a start have no chapter."""
    from ..functions.text import starts_chapter

    content = blocks.where(F.col("tag") != "sectPr")
    numbered = chapter_numbers(content, (F.col("tag") == "p") & starts_chapter(F.col("text"), pattern, regex, flags), doc_col, order_col)
    body = ordered_text(numbered.where((F.col("chapter_no") > 0) & (F.col("tag") == "p")), [doc_col, "chapter_no"], order_col, normalize_spaces(F.col("text")), "\n\n")
    headed = body.join(subject_headings(numbered, doc_col, order_col, among=F.col("tag") == "p"), doc_col, "left")
    return headed.select(doc_col, "chapter_no", "heading", F.concat_ws("\n\n", "heading", "text").alias("text"))


def full_text(paragraphs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """The whole text of each document, all parts and tables included."""
    placed = paragraphs.withColumn("_o", F.struct("part_no", "para_no"))
    return ordered_text(placed, [doc_col], "_o", normalize_spaces(F.col("text")), "\n\n")


def converter_of(fonts: Column) -> Column:
    """The converter of a run's font names: the first name that tells one."""
    one = lambda f: F.coalesce(*[F.when(F.lit(False) if not pats else _any_of(f, pats), F.lit(name)) for name, pats in FONT_PATTERNS.items()])
    return F.get(F.filter(F.transform(F.coalesce(fonts, F.array().cast("array<string>")), one), lambda x: x.isNotNull()), F.lit(0))


def _any_of(c: Column, parts: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | F.lower(c).contains(p)
    return out


def islands(rows: DataFrame, key: Column, by: list[str], order_col: str) -> DataFrame:
    """Adds ``_key`` and ``island``, which counts changes of the key in order."""
    w = Window.partitionBy(*by).orderBy(order_col)
    marked = rows.withColumn("_key", key).withColumn("_new", (~F.col("_key").eqNullSafe(F.lag("_key").over(w)) | (F.row_number().over(w) == 1)).cast("int"))
    return marked.withColumn("island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("_new")


def font_groups(runs: DataFrame) -> DataFrame:
    """Runs (doc, part, para_no, run_no, fonts, text, n_texts) of one converter in a row, as groups. A run without a converter or
    without text nodes breaks a group."""
    by = ["doc", "part", "para_no"]
    key = F.when(F.col("n_texts") > 0, converter_of(F.col("fonts")))
    kept = islands(runs, key, by, "run_no").where(F.col("_key").isNotNull())
    lists = kept.groupBy(*by, "island", F.col("_key").alias("converter")).agg(F.min("run_no").alias("first_run"), F.max("run_no").alias("last_run"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("run_no", "text"))), lambda s: s["text"]), "").alias("text"))
    return lists.where(F.col("text") != "").drop("island")


def postprocess(text: Column, converter: Column) -> Column:
    """Mends after conversion; no space before a danda."""
    mended = F.when(converter == "aps", F.replace(text, F.lit("वैâ"), F.lit("कै"))).otherwise(text)
    return F.replace(mended, F.lit(" ।"), F.lit("।"))


def convert_groups(groups: DataFrame, converters: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Adds ``converted``: each group through the converter it names (a function of a column, such as a pandas UDF). The font
    mappings themselves are not part of this library."""
    none = F.lit(None).cast("string")
    out = groups.where(F.col("converter").isNull() | ~F.col("converter").isin(list(converters))).withColumn("converted", none)
    for name, convert in converters.items():  # each converter meets its own rows alone
        out = out.unionByName(groups.where(F.col("converter") == name).withColumn("converted", convert(F.col("text"))))
    return out.withColumn("converted", postprocess(F.col("converted"), F.col("converter")))


def converted_text(converted: DataFrame, doc_col: str = "doc") -> DataFrame:
    """The whole text of each document as its converted groups alone; runs that needed no converter are not in it."""
    return ordered_text(converted.withColumn("_o", F.struct("part", "para_no", "first_run")), [doc_col], "_o", normalize_spaces(F.col("converted")), "\n\n")


def converter_counts(groups: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Groups per converter, as a map."""
    per = groups.groupBy(doc_col, "converter").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy(doc_col).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("converter", "n")))).alias("converter_counts"))
