"""Whitespace-separated words, by the Unicode definition of whitespace."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: all Unicode white space, plus the four information separators, which Python's
# str.split() also splits on.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"


def words(text: Column) -> Column:
    """The non-empty words of ``text``, as an array."""
    return F.filter(F.split(text, WHITESPACE), lambda w: w != "")
