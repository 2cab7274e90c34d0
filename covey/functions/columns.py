"""Small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column(name: str) -> Column:
    """A top-level column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def finite(value: Column, dtype: T.DataType) -> Column:
    """``value`` with NaN and the infinities turned into null (fractional types only)."""
    if not isinstance(dtype, (T.DoubleType, T.FloatType)):
        return value
    # abs(NaN) < inf is false in Spark, where NaN sorts above every number.
    return F.when(F.abs(value) < F.lit(float("inf")), value)
