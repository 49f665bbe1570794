"""Text columns: white space as Unicode has it, names, statistics, markers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space: Java's own \s knows ASCII only.
WS = r"[\x1c-\x1f\x{85}\s\p{Z}]"
NOT_WS = r"[^\x1c-\x1f\x{85}\s\p{Z}]"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"\A{WS}+|{WS}+\z", "")


def normalize_spaces(c: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return strip(F.regexp_replace(c, f"{WS}+", " "))


def remove_whitespace(c: Column) -> Column:
    return F.regexp_replace(c, WS, "")


def is_blank(c: Column) -> Column:
    return F.coalesce(strip(c), F.lit("")) == ""


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def safe_filename(c: Column, fallback: str = "chapter") -> Column:
    """Reserved characters and spaces become dashes; 80 characters at most."""
    s = F.regexp_replace(normalize_spaces(c), r'[\\/:*?"<>|]+', "-")
    s = F.regexp_replace(F.regexp_replace(s, f"{WS}+", "-"), r"\A[.-]+|[.-]+\z", "")
    return F.coalesce(F.nullif(F.substring(s, 1, 80), F.lit("")), F.lit(fallback))


def artifact_name(category: Column, subject: Column, slug: Column, chapter: Column, version: Column, subversion: Column, extension: str) -> Column:
    """CATEGORY_SUBJECT_slug_NNN_vM.m.ext; a null chapter names the full subject."""
    number = F.coalesce(F.format_string("%03d", chapter.cast("int")), F.lit("full")) if chapter is not None else F.lit("full")
    return F.concat(F.concat_ws("_", category, subject, slug, number, F.concat(F.lit("v"), version, F.lit("."), subversion)), F.lit(extension))


# fixed values: words that mark a lecture, a subject heading and an invocation
LECTURE_MARK = "प्रबोधन क्र"
SUBJECT_MARK = "विषय"
INVOCATION_MARKS = ("श्री स्वामी", "जय जय")
# end of fixed values
LECTURE_NUMBER = rf"प्रबोधन{WS}+क्र\.?{WS}*({NOT_WS}+)"


def fallback_title(c: Column, number: Column) -> Column:
    """The lecture's number where the text tells it, else the text itself, as a file name."""
    text = normalize_spaces(c)
    found = F.nullif(F.regexp_extract(text, LECTURE_NUMBER, 1), F.lit(""))
    prefix = F.format_string("%03d-", number.cast("int"))
    return F.when(found.isNotNull(), F.concat(prefix, F.lit("प्रबोधन-क्र-"), safe_filename(found))).otherwise(F.concat(prefix, safe_filename(text)))


def starts_chapter(c: Column, pattern: str, regex: bool = False, flags: str = "") -> Column:
    """Whether a block opens a chapter: it contains ``pattern``, or matches it anywhere (``flags`` of i, m, s, x)."""
    return c.rlike((f"(?{flags})" if flags else "") + pattern) if regex else c.contains(pattern)


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(f"{NOT_WS}+")).cast("long")


def line_blocks(c: Column) -> Column:
    """Lines that are not blank, white space collapsed."""
    return F.transform(F.filter(F.split(strip(c), "\n"), lambda p: ~is_blank(p)), normalize_spaces)


def paragraphs(c: Column) -> Column:
    """Parts between blank lines that are not blank."""
    return F.filter(F.split(strip(c), rf"\n{WS}*\n"), lambda p: ~is_blank(p))


def text_stats(c: Column) -> Column:
    return F.struct(word_count(c).alias("word_count"), F.char_length(c).cast("long").alias("character_count"), F.size(paragraphs(c)).cast("long").alias("paragraph_count"))


def marker_tags(c: Column, markers: list[str], tags: list[str]) -> Column:
    """``tags`` where the text holds any marker, else an empty array. Both sides are compared in normal form C."""
    import unicodedata

    from .identity import nfc

    hit, normal = F.lit(False), nfc(c)
    for m in markers:
        hit = hit | normal.contains(unicodedata.normalize("NFC", m))
    return F.when(hit, F.array(*map(F.lit, tags))).otherwise(F.array().cast("array<string>"))


def utc_stamp(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def utc_file_stamp(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd'T'HHmmss'Z'")
