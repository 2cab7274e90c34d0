"""Readers. Each takes the caller's session and returns a lazy DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Columnar scan, schema from the files; Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(path)


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """One JSON document per line. Without a schema, Spark infers one in an extra full pass."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, in ``value``."""
    return spark.read.text(path)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, empty_as: str | None = None
) -> DataFrame:
    """CSV with a header line. ``empty_as`` is the mark ``write_csv_parts`` put in place of an
    empty string; without it both '' and null come back as null."""
    reader = spark.read.schema(schema).option("header", True)
    if empty_as is None:
        return reader.csv(path)
    df = reader.option("emptyValue", empty_as).csv(path)
    return df.replace({empty_as: ""}, subset=_string_columns(schema))


def _string_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
