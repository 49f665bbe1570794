"""Token counts and ratios."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import remove_whitespace, word_count


def token_ratio(tokens: Column, words: Column) -> Column:
    """Tokens per word; null without words."""
    return F.try_divide(tokens.cast("double"), words.cast("double"))


def words_per_budget(ratio: Column, budget: int = 700) -> Column:
    """Words that fit ``budget`` tokens; null where the ratio is null or zero."""
    return F.lit(float(budget)) / F.nullif(ratio, F.lit(0.0))


def token_counts(docs: DataFrame, count: Callable[[Column], Column], id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per document: characters, words of the original, and tokens of the text without white space."""
    text, bare = F.col(text_col), remove_whitespace(F.col(text_col))
    rows = docs.select(id_col, *keep, F.char_length(text).cast("long").alias("original_char_count"), F.char_length(bare).cast("long").alias("normalized_char_count"), word_count(text).alias("word_count"), F.when(bare == "", 0).otherwise(count(bare)).cast("long").alias("token_count"))
    ratio = token_ratio(F.col("token_count"), F.col("word_count"))
    return rows.withColumn("tokens_per_word", ratio).withColumn("words_per_budget", words_per_budget(F.col("tokens_per_word")))


def token_summary(counts: DataFrame, *by: str) -> DataFrame:
    """A ratio of sums, not a mean of ratios."""
    sums = counts.groupBy(*by).agg(F.count(F.lit(1)).alias("documents"), F.sum("word_count").alias("word_count"), F.sum("token_count").alias("token_count"))
    return sums.withColumn("tokens_per_word", token_ratio(F.col("token_count"), F.col("word_count"))).withColumn("words_per_budget", words_per_budget(F.col("tokens_per_word")))
