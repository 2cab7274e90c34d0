"""Normalise any column to document values: what a JSON store can hold without loss of meaning.

The rewrite is decided from the schema once, on the driver, and runs as built-in expressions:
no Python touches a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covey.functions.columns import column, finite

_INSTANTS = (T.TimestampType, T.TimestampNTZType)
_WHOLE_SECONDS = len("2020-01-02T03:04:05")
_MICROSECONDS = len("2020-01-02T03:04:05.678901")


def as_documents(df: DataFrame) -> DataFrame:
    """``df`` with every column normalised and its name kept."""
    return df.select(
        *[document_value(column(f.name), f.dataType).alias(f.name) for f in df.schema.fields]
    )


def document_value(value: Column, dtype: T.DataType) -> Column:
    """Decimal and float become double, NaN and infinities null, instants ISO-8601 text,
    dates ISO text, binary base64; arrays, maps and structs are rewritten inside."""
    if not _needs_rewrite(dtype):
        return value
    if isinstance(dtype, T.DecimalType):
        return value.cast("double")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return finite(value, dtype).cast("double")
    if isinstance(dtype, _INSTANTS):
        return iso_instant(value)
    if isinstance(dtype, T.DateType):
        return F.date_format(value, "yyyy-MM-dd")
    if isinstance(dtype, T.BinaryType):
        return F.base64(value)
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda e: document_value(e, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(value, lambda _, v: document_value(v, dtype.valueType))
    fields = [document_value(value.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
    return F.when(value.isNotNull(), F.struct(*fields))


def iso_instant(value: Column) -> Column:
    """``2020-01-02T03:04:05``, with six fraction digits only where the fraction is not zero."""
    # Spark's own text has a space for the T and drops trailing zeros of the fraction.
    text = F.translate(value.cast("string"), " ", "T")
    return F.when(F.length(text) > _WHOLE_SECONDS, F.rpad(text, _MICROSECONDS, "0")).otherwise(text)


def _needs_rewrite(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _needs_rewrite(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _needs_rewrite(dtype.valueType)
    if isinstance(dtype, T.StructType):
        return any(_needs_rewrite(f.dataType) for f in dtype.fields)
    return isinstance(
        dtype,
        (T.DecimalType, T.DoubleType, T.FloatType, T.DateType, T.BinaryType, *_INSTANTS),
    )
