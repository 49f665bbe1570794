import hashlib
import re
import unicodedata
import uuid

import pytest
from pyspark.sql import functions as F

from corpusprep.functions import identity, text
from corpusprep.operators.sentences import sentence_spans

NAMESPACE = "4b3f0c9e-52d4-4c39-9f0a-0d5a7c1e8b21"


def apply(spark, values, column):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(column(F.col("t"))).collect()]


ODD = ["", "  a b \x1c c \n", "\u0085x　", "a\tb\x1fc", "no", "नमस्ते  जय", "​x"]


def test_white_space_is_that_of_unicode(spark):
    assert apply(spark, ODD, text.normalize_spaces) == [" ".join(t.split()) for t in ODD]
    assert apply(spark, ODD, text.strip) == [t.strip() for t in ODD]
    assert apply(spark, ODD, text.remove_whitespace) == ["".join(t.split()) for t in ODD]
    assert apply(spark, ODD, text.is_blank) == [not t.strip() for t in ODD]


def test_safe_filename(spark):
    given = ["a / b:c", "..x..", "   ", "?" * 3, "y" * 200, "क ख"]
    assert apply(spark, given, text.safe_filename) == ["a---b-c", "x", "chapter", "chapter", "y" * 80, "क-ख"]


def test_text_stats(spark):
    given = ["one two\n\nthree\n \n\n four", "", " \n\n "]
    got = apply(spark, given, text.text_stats)
    assert [(r.word_count, r.character_count, r.paragraph_count) for r in got] == [(4, 23, 3), (0, 0, 0), (0, 4, 0)]


def test_markers_and_titles(spark):
    assert apply(spark, ["a summary b", "none"], lambda c: text.marker_tags(c, ["summary"], ["x", "y"])) == [["x", "y"], []]
    assert apply(spark, ["प्रबोधन क्र. 12 विषय", "Some title"], lambda c: text.fallback_title(c, F.lit(3))) == ["003-प्रबोधन-क्र-12", "003-Some-title"]
    assert apply(spark, ["Chapter 1", "x chapter"], lambda c: text.starts_chapter(c, "^chapter", regex=True, flags="i")) == [True, False]


def normalized(t):
    t = unicodedata.normalize("NFC", t).replace("\r\n", "\n").replace("\r", "\n")
    return "\n".join(line.rstrip(" \t") for line in t.split("\n")).strip()


def test_identity(spark):
    given = ["é x \t\r\ny\r z  ", "a  b", "क़\n", "  "]
    assert apply(spark, given, identity.normalize_content) == [normalized(t) for t in given]
    sha = [hashlib.sha256(normalized(t).encode()).hexdigest() for t in given]
    assert apply(spark, given, identity.content_sha256) == sha
    key = lambda c: identity.content_identity(NAMESPACE, F.lit("CAT001"), F.lit("SUB001"), F.lit("hi"), c)["content_key"]
    assert apply(spark, given, key) == [str(uuid.uuid5(uuid.UUID(NAMESPACE), f"v1|CAT001|SUB001|hi|{s}")) for s in sha]
    blank = lambda c: identity.content_key(NAMESPACE, F.lit(" "), F.lit("S"), F.lit("hi"), identity.content_sha256(c))
    assert apply(spark, ["x"], blank) == [None]
    assert apply(spark, ["A" * 64], lambda c: identity.content_key(NAMESPACE, F.lit("C"), F.lit("S"), F.lit("hi"), c)) == [None]


def test_three_hashes_differ(spark):
    one = lambda f: apply(spark, ["a b \n"], f)[0]
    assert len({one(identity.artifact_sha256), one(identity.content_sha256), one(identity.spaceless_sha256)}) == 3


def test_driver_side_helpers():
    assert identity.config_fingerprint({"b": 1, "a": 2}) == identity.config_fingerprint({"a": 2, "b": 1})
    assert identity.redact({"token": "x", "inner": [{"api_key": "y", "name": "z"}]}) == {"token": "[redacted]", "inner": [{"api_key": "[redacted]", "name": "z"}]}


def spans(t):
    """The rule in plain words, character by character."""
    out, cursor = [], 0
    cuts = [m.end() for m in re.finditer(r"[।!?.]+[\"'”’]?(?=\s|\Z)", t)]
    for end in [*cuts, len(t)]:
        piece = t[cursor:end]
        if piece.strip():
            start = cursor + len(piece) - len(piece.lstrip())
            out.append((start, start + len(piece.strip()), " ".join(piece.split())))
        cursor = end
    return out


@pytest.mark.parametrize("t", ["", "   ", "One. Two! Three", "!? start. x", 'He said "no." Then left.', "राम।। श्याम। अंत", "pi is 3.14 now. e", "a\x1cb. c", "𝒜 b. 𝒞 d?", "no end", "tail.  \n", "x..y . z"])
def test_sentence_spans(spark, t):
    got = sentence_spans(spark.createDataFrame([(1, t)], "doc_id int, text string")).orderBy("source_index").collect()
    assert [(r.start_char, r.end_char, r.text) for r in got] == spans(t)
    assert all(" ".join(t[r.start_char : r.end_char].split()) == r.text for r in got)
