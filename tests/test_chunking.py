import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusprep.operators import chunking, tokens


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def alternating(column):
    """Even windows get one vector, odd ones another."""

    @F.pandas_udf("array<float>")
    def encode(s: pd.Series) -> pd.Series:
        return s.map(lambda t: np.array([1, 0] if t.startswith("A") else [0, 1], np.float32))

    return encode(column)


def fold(groups, least):
    """Gather groups until the joined text is long enough."""
    if least <= 0 or len(groups) <= 1:
        return groups
    done, now = [], []
    for g in groups:
        now = now + g
        if len(" ".join(now)) >= least:
            done.append(now)
            now = []
    if now:
        if done:
            done[-1] += now
        else:
            done.append(now)
    return done


@pytest.mark.parametrize("least", [0, 1, 12, 30, 500])
def test_merge_small(spark, least):
    rng = np.random.default_rng(least)
    for _ in range(2):
        groups = [["x" * int(rng.integers(1, 12)) for _ in range(int(rng.integers(1, 4)))] for _ in range(int(rng.integers(1, 9)))]
        rows, at = [], 0
        for g in groups:
            rows.append((at, at + len(g) - 1, len(" ".join(g))))
            at += len(g)
        got = spark.createDataFrame([(rows,)], "g array<struct<first:int,last:int,chars:int>>").select(chunking.merge_small(F.col("g"), least).alias("m")).first().m
        assert [len(x) for x in fold(groups, least)] == [r["last"] - r["first"] + 1 for r in got]


def test_two_sentences_make_two_chunks(spark):
    config = chunking.ChunkConfig(threshold_percentile=50, min_chars=0, window_size=1)
    got = chunking.semantic_chunks(docs(spark, "A first one.\n\nB second one."), config, alternating).orderBy("index").collect()
    assert [(r["index"], r.text, r.start_char, r.end_char, r.sentence_count) for r in got] == [(1, "A first one.", 0, 12, 1), (2, "B second one.", 14, 27, 1)]


def test_blank_and_single(spark):
    d = docs(spark, "", "  \n", "Only one", None)
    chunks = chunking.semantic_chunks(d)
    assert [(r.doc_id, r.text) for r in chunks.collect()] == [(2, "Only one")]
    assert all(r.is_covered for r in chunking.chunk_coverage(d, chunks).collect())


def test_equal_distances_all_break(spark):
    got = chunking.semantic_chunks(docs(spark, "A a. B b. A c. B d."), chunking.ChunkConfig(80, 0, 1), alternating)
    assert got.count() == 4


def test_percentile_matches_linear_interpolation(spark):
    rng = np.random.default_rng(3)
    rows = [(g, i, float(x)) for g in range(20) for i, x in enumerate(rng.random(int(rng.integers(1, 30))))]
    df = spark.createDataFrame(rows, "g int, i int, distance double")
    got = chunking.breakpoints(df, 78, "g", "i").collect()
    for g in range(20):
        values = [x for h, _, x in rows if h == g]
        want = np.percentile(values, 78)
        assert {r.i for r in got if r.g == g and r.is_break} == {i for i, x in enumerate(values) if x >= want - 1e-15}


def test_zero_vectors_are_far(spark):
    df = spark.createDataFrame([(1, 0, [0.0, 0.0]), (1, 1, [1.0, 0.0]), (1, 2, [1.0, 0.0])], "d int, i int, v array<float>")
    got = chunking.adjacent_distance(df, "d", "i", "v").orderBy("i").collect()
    assert [r.distance for r in got] == [None, 1.0, 0.0]


def test_coverage_finds_gaps(spark):
    d = docs(spark, "One. Two. Three.")
    chunks = chunking.semantic_chunks(d, chunking.ChunkConfig(0, 0, 1))
    assert not chunking.chunk_coverage(d, chunks.where("index <> 2")).first().is_covered
    with pytest.raises(ValueError, match="do not cover"):
        chunking.require_covered(chunking.chunk_coverage(d, chunks.where("index < 3")))


@pytest.mark.parametrize("bad", [{"threshold_percentile": 101}, {"min_chars": -1}, {"window_size": 0}, {"batch_size": 0}, {"device": "x"}])
def test_config_bounds(bad):
    with pytest.raises(ValueError):
        chunking.ChunkConfig(**bad)


def test_token_ratios(spark):
    counts = tokens.token_counts(docs(spark, "ab cd", " ", "é"), F.char_length)
    rows = {r.doc_id: r for r in counts.collect()}
    assert (rows[0].token_count, rows[0].word_count, rows[0].tokens_per_word, rows[0].words_per_budget) == (4, 2, 2.0, 350.0)
    assert (rows[1].token_count, rows[1].tokens_per_word, rows[1].words_per_budget) == (0, None, None)
    s = tokens.token_summary(counts).first()
    assert (s.token_count, s.word_count, round(s.tokens_per_word, 3)) == (5, 3, 1.667)
