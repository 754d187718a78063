"""Word count (S-01, F-20, A-01, O-01)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions.text import words_on_space


def word_count(lines: DataFrame, col: str = "value") -> DataFrame:
    """A-01: words split on single spaces (empty tokens counted, as the
    job being matched does); hash aggregate with map-side combine, so a
    word holding a third of all tokens is summed inside each task first."""
    words = lines.select(F.explode(words_on_space(col)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def text_lines(df: DataFrame, col: str = "text") -> DataFrame:
    """Lines of a text column (a document's text read as a file)."""
    return df.select(F.explode(F.split(F.col(col), "\n")).alias("value"))


def sorted_word_count(lines: DataFrame, col: str = "value", ascending: bool = True) -> DataFrame:
    """O-01: total sort by count; ties by word so the order is stable."""
    wc = word_count(lines, col)
    c = F.col("count").asc() if ascending else F.col("count").desc()
    return wc.orderBy(c, F.col("word").asc())


def top_words(lines: DataFrame, k: int, col: str = "value") -> DataFrame:
    """Most frequent ``k`` words (top-k: a per-task heap, then a merge)."""
    return sorted_word_count(lines, col, ascending=False).limit(k)
