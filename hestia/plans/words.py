"""Word count over descriptions.

Tokens are produced by built-in functions per row, exploded, and counted
with one aggregate whose partial phase combines hot words (``dans``,
``pièces``…) inside each task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hestia.functions.text import tokens
from hestia.operators.ranking import ranked, sort_by


def word_pairs(df: DataFrame, col: str) -> DataFrame:
    """One ``(word, 1)`` row per token; null texts are skipped."""
    return df.filter(F.col(col).isNotNull()).select(F.explode(tokens(col)).alias("word"), F.lit(1).alias("one"))


def word_count(df: DataFrame, col: str) -> DataFrame:
    """``(word, count)`` over all texts, the most frequent first."""
    return sort_by(_counts(df, col), [("count", "desc"), ("word", "asc")])


def _counts(df: DataFrame, col: str) -> DataFrame:
    return word_pairs(df, col).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def top_words(df: DataFrame, col: str, k: int = 30) -> DataFrame:
    """The ``k`` most frequent words with their rank (ties by word)."""
    return ranked(_counts(df, col), [("count", "desc"), ("word", "asc")], k)
