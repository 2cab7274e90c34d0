"""Counts of Parquet tables from their footers: no data page is read."""

from __future__ import annotations

import contextlib
import itertools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covey.functions.columns import column
from covey.sources.shared import settings


@dataclass(frozen=True)
class Counts:
    """Rows of a table, and the rows in which each column is not null."""

    rows: int
    non_null: dict[str, int]


def counts(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> Counts:
    """Rows and non-null values of top-level columns.

    Spark looks a column's count up by its place among the table's columns, but footers list what
    nested columns consist of. So only plain columns before the first nested one are told by
    footers; the others are read. So are all where a writer left the counts out."""
    df = spark.read.parquet(path)
    told = _told_by_footers(df.schema)
    by_footer = [c for c in columns if c in told]
    by_reading = [c for c in columns if c not in told]
    try:
        with footers_only(spark, path) as pushed:
            found = _named(pushed.agg(*_wanted(by_footer)).first(), by_footer)
    except PySparkException:
        found, by_reading = {}, list(columns)
    if by_reading or not found:
        found |= _named(df.agg(*_wanted(by_reading)).first(), by_reading)
    return Counts(found[None], {c: found[c] for c in columns})


def _named(row: Row, columns: list[str]) -> dict[str | None, int]:
    # Pushed counts are summed up, and the sum over no file is null.
    return {None: row["n"] or 0} | {c: row[f"c{i}"] or 0 for i, c in enumerate(columns)}


def _told_by_footers(schema: T.StructType) -> set[str]:
    plain = itertools.takewhile(
        lambda f: not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)), schema.fields
    )
    return {f.name for f in plain}


def _wanted(columns: Sequence[str]) -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), *[F.count(column(c)).alias(f"c{i}") for i, c in enumerate(columns)]]


@contextlib.contextmanager
def footers_only(spark: SparkSession, path: str) -> Iterator[DataFrame]:
    """The table, read so that counts over it are answered by the footers while the block lasts."""
    formats = spark.conf.get("spark.sql.sources.useV1SourceList").split(",")
    values = {
        "spark.sql.sources.useV1SourceList": ",".join(f for f in formats if f.strip() != "parquet"),
        "spark.sql.parquet.aggregatePushdown": "true",
    }
    with settings(spark, values):
        yield spark.read.parquet(path)
