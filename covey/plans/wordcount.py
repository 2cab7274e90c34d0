"""The word-count job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from covey.operators.words import word_count
from covey.sources.tables import read_text_lines


def word_count_job(spark: SparkSession, path: str) -> DataFrame:
    return word_count(read_text_lines(spark, path))
