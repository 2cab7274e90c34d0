"""Discover usable numeric columns, and bring tables to a fixed set of typed columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covey.errors import EmptyInput, NoCompleteColumns, NoNumericColumns, NoVaryingColumns
from covey.functions.columns import column, finite
from covey.functions.flatten import name_columns
from covey.params import NUMERIC_TYPES, Params
from covey.sources.footers import counts


def numeric_columns(
    schema: T.StructType, types: tuple[type, ...] = NUMERIC_TYPES
) -> list[str]:
    """Top-level columns of a numeric type, in schema order."""
    return [f.name for f in schema.fields if isinstance(f.dataType, types)]


# A count, a deviation and the extremes are six fields of an aggregation; Spark generates code up
# to 100.
_COLUMNS_AT_ONCE = 16
_PARTIAL = "position int, n long, non_null long, mean double, squares double, least double, most double"


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: ``position, column_name, n, non_null, ratio, std``.

    A single pass over the listed columns only, partially aggregated before the one-row shuffle.
    NaN counts as present; the deviation of a column holding NaN or an infinity is NaN, and that of
    a column of equal numbers exactly 0, however its parts' means were rounded. Tables of many columns are read in blocks of them, and aggregated by the column's position: the plan has
    the same few expressions for any width.
    """
    if len(columns) > _COLUMNS_AT_ONCE:
        return _wide_profile(df, columns)
    profile = [F.count("*").alias("n")]
    for i, name in enumerate(columns):
        profile.append(F.count(column(name)).alias(f"non_null_{i}"))
        value = column(name).cast("double")
        profile.append(_deviation(F.stddev_samp(value), F.min(value), F.max(value)).alias(f"std_{i}"))
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column_name"),
            F.col("n"),
            F.col(f"non_null_{i}").alias("non_null"),
            F.try_divide(f"non_null_{i}", "n").alias("ratio"),
            F.col(f"std_{i}").alias("std"),
        )
        for i, name in enumerate(columns)
    ]
    return df.agg(*profile).select(F.inline(F.array(*rows)))


def _deviation(std: Column, least: Column, most: Column) -> Column:
    return F.when((least == most) & (std >= 0) & ~F.isnan(std), F.lit(0.0)).otherwise(std)


def _wide_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    # Every position has a record, also where there is no task.
    nothing = (
        "CAST(id AS INT) AS position, 0L AS n, 0L AS non_null, 0.0D AS mean, 0.0D AS squares, "
        "CAST(NULL AS DOUBLE) AS least, CAST(NULL AS DOUBLE) AS most"
    )
    partial = df.sparkSession.range(0, len(columns), 1, 1).selectExpr(*nothing.split(", "))
    for at in range(0, len(columns), 4 * _COLUMNS_AT_ONCE):
        block = columns[at : at + 4 * _COLUMNS_AT_ONCE]
        plain = df.select(*[column(c).alias(f"c{i}") for i, c in enumerate(block)])
        partial = partial.unionAll(plain.mapInArrow(_moments(at, len(block)), _PARTIAL))
    # One record per task and column; two of them make one by their counts, means and squares.
    zero = F.struct(F.lit(0).cast("long").alias("non_null"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("squares"))

    def merge(a: Column, b: Column) -> Column:
        n = a["non_null"] + b["non_null"]
        apart, share = b["mean"] - a["mean"], b["non_null"] / F.greatest(n, F.lit(1))
        return (
            F.when(b["non_null"] == 0, a)
            .when(a["non_null"] == 0, b)
            .otherwise(
                F.struct(
                    n.alias("non_null"),
                    (a["mean"] + apart * share).alias("mean"),
                    (a["squares"] + b["squares"] + apart * apart * share * a["non_null"]).alias("squares"),
                )
            )
        )

    each = F.struct("non_null", "mean", "squares")
    merged = partial.groupBy("position").agg(
        F.sum("n").alias("n"),
        F.aggregate(F.collect_list(each), zero, merge).alias("all"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
    )
    std = F.when(F.col("all.non_null") > 1, F.sqrt(F.col("all.squares") / (F.col("all.non_null") - 1)))
    names = F.array(*[F.lit(c) for c in columns])
    return merged.select(
        "position",
        F.get(names, "position").alias("column_name"),
        "n",
        F.col("all.non_null").alias("non_null"),
        F.try_divide("all.non_null", "n").alias("ratio"),
        _deviation(std, F.col("least"), F.col("most")).alias("std"),
    )


def _moments(first: int, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows, filled rows, mean, squares about the mean, and extremes of each column of a task."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, filled, mean, squares = 0, np.zeros(width, np.int64), np.zeros(width), np.zeros(width)
        least, most = np.full(width, np.inf), np.full(width, -np.inf)
        with np.errstate(invalid="ignore", over="ignore"):
            for batch in batches:
                n += batch.num_rows
                for i, values in enumerate(batch.columns):
                    x = values.drop_null().cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
                    if not len(x):
                        continue
                    here = x.mean()
                    least[i], most[i] = min(least[i], x.min()), max(most[i], x.max())
                    apart, total = here - mean[i], filled[i] + len(x)
                    squares[i] += ((x - here) ** 2).sum() + apart * apart * filled[i] * len(x) / total
                    mean[i], filled[i] = (here if not filled[i] else mean[i] + apart * len(x) / total), total
        yield pa.record_batch(
            [
                pa.array(np.arange(first, first + width, dtype=np.int32)),
                pa.array(np.full(width, n)),
                pa.array(filled),
                pa.array(mean),
                pa.array(squares),
                pa.array(least, mask=filled == 0),
                pa.array(most, mask=filled == 0),
            ],
            ["position", "n", "non_null", "mean", "squares", "least", "most"],
        )

    return add


def is_complete(min_ratio: float) -> Column:
    """On a profile: filled often enough (inclusive)."""
    return F.col("ratio") >= F.lit(min_ratio)


def is_varying() -> Column:
    """On a profile: a positive deviation. Null (one value) and NaN (not finite) do not count;
    NaN has to be named, as it sorts above every number."""
    return F.coalesce((F.col("std") > 0) & ~F.isnan("std"), F.lit(False))


def select_features(df: DataFrame, params: Params) -> tuple[list[str], int]:
    """The feature columns in schema order, and the number of rows, from one job."""
    candidates = numeric_columns(df.schema, params.numeric_types)
    if not candidates:
        raise EmptyInput() if df.isEmpty() else NoNumericColumns()
    # One row per column of the schema: bounded by the table's width.
    profile = (
        column_profile(df, candidates)
        .select(
            "position",
            "column_name",
            "n",
            is_complete(params.min_non_null_ratio).alias("complete"),
            is_varying().alias("varying"),
        )
        .orderBy("position")
        .collect()
    )
    complete = [row.column_name for row in profile if row.complete]
    varying = [row.column_name for row in profile if row.complete and row.varying]
    return _guarded(profile[0].n, complete, varying, params), profile[0].n


def select_stored_features(
    spark: SparkSession, path: str, params: Params
) -> tuple[list[str], int]:
    """The same of a Parquet table: the footers tell the rows and which columns are filled, and only
    these columns are read."""
    df = spark.read.parquet(path)
    candidates = numeric_columns(df.schema, params.numeric_types)
    if not candidates:
        raise EmptyInput() if df.isEmpty() else NoNumericColumns()
    found = counts(spark, path, candidates)
    complete = [c for c in candidates if found.rows and found.non_null[c] / found.rows >= params.min_non_null_ratio]
    varying = []
    if complete:
        rows = column_profile(df, complete).where(is_varying()).orderBy("position").collect()
        varying = [row.column_name for row in rows]
    return _guarded(found.rows, complete, varying, params), found.rows


def _guarded(total: int, complete: list[str], varying: list[str], params: Params) -> list[str]:
    if total == 0:
        raise EmptyInput()
    if not complete:
        raise NoCompleteColumns(params.min_non_null_ratio)
    if not varying:
        raise NoVaryingColumns()
    return varying


def as_double(name: str, nonfinite_as_null: bool = False) -> Column:
    """A column as double. Decimals and longs lose what a double cannot hold."""
    value = column(name).cast("double")
    if nonfinite_as_null:
        # Judged after the cast: a text may spell an infinity.
        value = finite(value, T.DoubleType())
    return value.alias(name)


def cast_features(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[as_double(name) for name in names])


def align(
    df: DataFrame,
    feature_cols: Sequence[str],
    product_cols: Sequence[str],
    name_column: str = "product_name",
    nonfinite_as_null: bool = True,
) -> DataFrame:
    """Exactly the expected columns, in order: names as strings, features as doubles.

    What the table lacks becomes a typed null, what it has beyond that is never read.
    """
    flattened = name_columns(df.schema, name_column)
    names = [
        flattened.get(name, F.lit(None).cast("string")).alias(name) for name in product_cols
    ]
    features = [
        as_double(name, nonfinite_as_null)
        if name in df.columns
        else F.lit(None).cast("double").alias(name)
        for name in feature_cols
    ]
    return df.select(*names, *features)
