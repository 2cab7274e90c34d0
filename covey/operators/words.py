"""Count words over lines of text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covey.functions.columns import column
from covey.functions.text import words


def word_count(lines: DataFrame, text: str = "value") -> DataFrame:
    """``(word, n)`` sorted by word. Words are counted before the shuffle, so a word that makes
    up a third of the text costs one row per task."""
    return (
        lines.select(F.explode(words(column(text))).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .orderBy("word")
    )
