"""Uniform keys of row content, for samples that do not depend on how rows are laid out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covey.functions.columns import column


@dataclass(frozen=True)
class ContentKey:
    """A key of a row's content and a seed.

    It depends on nothing but the values, so it is the same whatever the file layout, the
    partitioning or the number of task retries.

    ``xxhash64`` hashes the binary values and is many times cheaper; ``md5`` hashes their text,
    which other engines can repeat.
    """

    schema: T.StructType
    seed: int
    algorithm: str = "xxhash64"

    def __post_init__(self) -> None:
        if self.algorithm not in ("xxhash64", "md5"):
            raise ValueError(f"unknown key algorithm {self.algorithm!r}")

    def text(self) -> Column:
        """The key as 32 hex digits."""
        if self.algorithm == "md5":
            return self._md5()
        halves = [F.lpad(F.hex(self._xxhash64(half)), 16, "0") for half in (0, 1)]
        return F.lower(F.concat(*halves))

    def below(self, share: float) -> Column:
        """True for the rows whose key lies in the lowest ``share`` of all possible keys."""
        if self.algorithm == "md5":
            return self._md5() < format(int(share * 2**64), "016x")
        # On the number itself: no text is made of the rows that are turned away.
        return F.shiftrightunsigned(self._xxhash64(0), 1) < F.lit(int(share * 2**63)).cast("long")

    def _xxhash64(self, half: int) -> Column:
        # A null leaves this hash unchanged, hence a flag beside every value.
        parts = [p for f in self.schema.fields for p in (_canonical(f), column(f.name).isNull())]
        return F.xxhash64(F.lit(self.seed), F.lit(half), *parts)

    def _md5(self) -> Column:
        # Each value carries its length; a null adds an empty part, an empty string "0:".
        texts = [_canonical(f).cast("string") for f in self.schema.fields]
        parts = [F.concat_ws(":", F.length(text).cast("string"), text) for text in texts]
        return F.md5(F.concat_ws("|", F.lit(str(self.seed)), *parts))


def _canonical(field: T.StructField) -> Column:
    """The value as grouping sees it: -0.0 is 0.0."""
    value = column(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return F.when(value == 0, F.lit(0.0).cast(field.dataType)).otherwise(value)
    return value
