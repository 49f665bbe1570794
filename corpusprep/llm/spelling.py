"""Spelling variant grouping: words that differ by one inserted, deleted or replaced code point, found by sorted
permuterm rotations.

A word is closed by a terminator and all rotations of it are sorted. Cut out one code point and rotate so that what
stood after it comes first: two words that differ in just that place share this rotation and differ in its last code
point, and the word that lacks the code point is the rotation itself. So the neighbours by replacement and by an indel
are one prefix range of the sorted rotations, skipping the edited code point. Rotations are dealt by range and sorted;
windows scan each range. A range holds one word for each code point of the alphabet and the shorter word (91 at most
for the default alphabet), so no group grows with the corpus, and no pair is emitted: a range gives each of its words
the number of its neighbours there and the best of them. A pair meets in one range only: of a run of equal code points
the first alone stands for a deletion, since deleting any of them gives the same word.

Counts come from whole texts. A null or empty text has no words, and a null id is written ``null`` where ids are part
of a hash. Repeated rows count each. Ties between neighbours go to the smallest word in code-point order. An empty table
gives an empty table. A very long text is one array of runs in one task. Input columns are only read by name, so extra
columns with any names do no harm; the words table has the columns ``word`` and ``n``, without nulls or repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, materialize, partitions

RUN = r"[A-Za-zÀ-ÿ]+"
#: Closes a word; no run holds it, and it sorts before all letters.
END = "$"
#: Runs whose hash this divides lose one code point.
SLIP = 199


def slipped(doc_id: Column, run: Column, every: int = SLIP) -> Column:
    """``run`` without code point h mod length, where ``every`` divides h, the crc32 of ``<doc_id>:<run>``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), run))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 6, min_count: int = 5, every: int | None = SLIP) -> DataFrame:
    """``word``, ``n``: the lower-cased (A-Z alone) runs of letters of all texts, of ``min_chars`` code points and
    ``min_count`` occurrences at least. ``every`` None: runs as they are."""
    runs = docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(RUN), F.lit(0))).alias("run"))
    lowered = runs.where(F.char_length("run") >= min_chars).select("id", ascii_lower(F.col("run")).alias("run"))
    words = lowered.select((F.col("run") if every is None else slipped(F.col("id"), F.col("run"), every)).alias("word"))
    return words.where(F.char_length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """All rotations of the closed words, as ``range`` (all of a rotation but the edited code point), ``edited`` (that code
    point; empty where the rotation is the whole word), ``lead`` (the first of a run of equal code points), ``word``, ``n``."""
    w, size = F.col("word"), F.char_length("word")

    def turned(i: Column, skip: int) -> Column:
        return F.concat(F.substr(w, i + 1 + skip), F.lit(END), F.substr(w, F.lit(1), i))

    at = lambda i: F.substr(w, i + 1, F.lit(1))
    cut = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(turned(i, 1).alias("range"), at(i).alias("edited"), ((i == 0) | (at(i) != at(i - 1))).alias("lead")))
    whole = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(turned(i, 0).alias("range"), F.lit("").alias("edited"), F.lit(False).alias("lead")))
    return words.where(size > 0).select("word", "n", F.inline(F.concat(cut, whole)))


def neighbours(words: DataFrame) -> DataFrame:
    """``word``, ``n_near`` and ``best`` (struct of ``lack``, minus its count, and ``word``) of the words with a neighbour."""
    dealt = rotations(words).repartitionByRange(partitions(words.sparkSession), "range").sortWithinPartitions("range", "edited")
    scan = Window.partitionBy("range").orderBy("edited")
    whole = scan.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rank, cut = F.struct((-F.col("n")).alias("lack"), "word"), F.col("edited") != ""
    first = lambda c, over: F.min(c).over(over)
    of_cut, of_lead = F.when(cut, rank), F.when(F.col("lead"), rank)
    short = first(F.when(~cut, rank), whole)  # the word without the edited code point, one at most
    before, after = first(of_cut, scan.rowsBetween(Window.unboundedPreceding, -1)), first(of_cut, scan.rowsBetween(1, Window.unboundedFollowing))
    n_near = F.when(cut, F.count(of_cut).over(whole) - 1 + F.when(F.col("lead") & short.isNotNull(), 1).otherwise(0)).otherwise(F.count(of_lead).over(whole))
    best = F.when(cut, F.least(before, after, F.when(F.col("lead"), short))).otherwise(first(of_lead, whole))
    met = dealt.select("word", n_near.alias("n_near"), best.alias("best")).where(F.col("n_near") > 0)
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root`` from ``word``, ``form``: forms followed to the last. Counts grow along a chain, so it ends; each
    round doubles the steps that are taken at once."""
    now = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = materialize(now.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def group_variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """Every word with ``n``, ``n_near``, its ``form`` (the commonest neighbour, if it is ``ratio`` times as common), that
    form's count ``form_n``, and ``root``, where the forms lead in the end."""
    near = words.join(neighbours(words), "word", "left")
    has = -F.col("best.lack") >= ratio * F.col("n")
    found = materialize(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best.word")).alias("form"), F.when(has, -F.col("best.lack")).alias("form_n")))
    ends = roots(found.where(F.col("form").isNotNull()))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 6, min_count: int = 5, ratio: int = 5) -> DataFrame:
    """``group_variants`` of the words of ``docs``."""
    return group_variants(materialize(word_counts(docs, id_col, text_col, min_chars, min_count)), ratio)
