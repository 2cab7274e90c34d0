"""Turn a nested name column into plain string columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covey.functions.columns import column

# The fields read from an array of structs, the column suffixes they become,
# and the text placed between elements.
ARRAY_FIELD_SUFFIXES = {"lang": "langs", "text": "texts"}
SEPARATOR = " | "


def name_columns(schema: T.StructType, name: str = "product_name") -> dict[str, Column]:
    """Flattened columns of ``name``, keyed by output column, in output order.

    * absent column: nothing;
    * array of structs: one joined string per known field (null and empty arrays give '',
      null elements are skipped);
    * struct: one string per field;
    * anything else: the value as a string.
    """
    dtype = next((f.dataType for f in schema.fields if f.name == name), None)
    if dtype is None:
        return {}
    source = column(name)
    if isinstance(dtype, T.StructType):
        return {f"{name}_{f}": source.getField(f).cast("string") for f in dtype.fieldNames()}
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        present = set(dtype.elementType.fieldNames())
        return {
            f"{name}_{suffix}": _joined(source, field)
            for field, suffix in ARRAY_FIELD_SUFFIXES.items()
            if field in present
        }
    return {name: source.cast("string")}


def _joined(array: Column, field: str) -> Column:
    return F.concat_ws(SEPARATOR, F.transform(array, lambda e: e.getField(field).cast("string")))
