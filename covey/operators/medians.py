"""Exact lower medians of many columns, without gathering a column anywhere."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covey.functions.columns import column

_ACCURACY = 10_000
_BINS = 4_096
_SKETCHED_AT_MOST = 100_000
_RANKED_IN_ONE_TASK = 20_000


@dataclass
class _Bracket:
    """The median is the ``rank``-th of the ``inside`` values between ``low`` and ``high``; the
    ends themselves are out once the bracket is ``open``."""

    name: str
    low: float
    high: float
    rank: int
    inside: int
    slack: float = 2 / _ACCURACY
    open: bool = False
    # Most values fell into one bin: bins of equal width say little about them.
    bunched: bool = False

    @property
    def found(self) -> bool:
        return self.low == self.high

    @property
    def bins_per_unit(self) -> float:
        """How many bins of equal width there are to a unit; 0 where a sketch is of more use."""
        if self.inside <= _SKETCHED_AT_MOST:
            return 0.0
        width = self.high - self.low
        scale = _BINS / width if math.isfinite(width) else 0.0
        return scale if math.isfinite(scale) and not self.bunched else 0.0

    def holds(self, v: Column) -> Column:
        return (v > self.low) & (v < self.high) if self.open else v.between(self.low, self.high)

    def value(self) -> Column:
        v = _valid(self.name)
        return F.when(self.holds(v), v)

    def close_on(self, value: float) -> None:
        self.low = self.high = value
        self.open = False


def exact_lower_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """The smallest value with at least half of the valid values at or below it, per column.

    One aggregation finds the extremes; then each round narrows a bracket around the median, until
    few enough values are left in it to be ranked. A round counts the bracket's values by bins of
    equal width and goes on with the extremes of the bin that holds the median, which is found if
    these are equal. Bins follow from sums and products alone, so a larger value is never in an
    earlier bin, and the counts are exact.

    Where a bin keeps most of the values, the bracket has no finite width, or so few values are left
    that sketches cost little, a round is two aggregations: a quantile sketch proposes a narrow bracket, counting proves it. It keeps about 1
    value in 2,000, so the round count grows with the logarithm of the input. The proposal's two ends
    are values of the column and are counted on their own: either one of them is the median, or
    they leave the bracket. So every round that finds the median between them has fewer values
    inside, and one that doesn't looks wider.
    """
    brackets = _whole_columns(df, columns)
    while wide := [b for b in brackets if not b.found and b.inside > _RANKED_IN_ONE_TASK]:
        binned = [b for b in wide if b.bins_per_unit]
        if binned:
            _narrow_by_bins(df, binned)
        if sketched := [b for b in wide if b not in binned]:
            _narrow(df, sketched, _proposed(df, sketched))
    if rest := [b for b in brackets if not b.found]:
        _ranked(df, rest)
    medians: dict[str, float | None] = dict.fromkeys(columns)
    medians.update({b.name: b.low for b in brackets})
    return medians


def _valid(name: str) -> Column:
    v = column(name).cast("double")
    return F.when(~F.isnan(v), v)


def _whole_columns(df: DataFrame, columns: Sequence[str]) -> list[_Bracket]:
    """Every column that has a valid value, unbracketed."""
    whole = df.agg(
        *[
            F.struct(F.min(_valid(c)), F.max(_valid(c)), F.count(_valid(c))).alias(str(i))
            for i, c in enumerate(columns)
        ]
    ).first()
    return [
        _Bracket(name, low, high, (n + 1) // 2, n) for name, (low, high, n) in zip(columns, whole) if n > 0
    ]


def _narrow_by_bins(df: DataFrame, brackets: list[_Bracket]) -> None:
    """Each bracket's values counted by bin, in one aggregation of at most ``_BINS`` rows a column.
    The brackets' ends are finite, so NaN, which sorts above every number, is in none."""
    binned = []
    for i, b in enumerate(brackets):
        v = column(b.name).cast("double")
        at = F.floor((v - F.lit(b.low)) * F.lit(b.bins_per_unit))
        at = F.least(at, F.lit(_BINS - 1).cast("long")) + F.lit(i * _BINS)
        binned.append(F.when(b.holds(v), F.struct(at.alias("bin"), v.alias("value"))))
    counted = (
        df.select(F.inline(F.array(*binned)))
        .where("bin IS NOT NULL")
        .groupBy("bin")
        .agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        .orderBy("bin")
        .collect()
    )
    found: list[list] = [[] for _ in brackets]
    for row in counted:
        found[row["bin"] // _BINS].append(row)
    for b, bins in zip(brackets, found):
        for _, n, low, high in bins:
            if b.rank <= n:
                break
            b.rank -= n
        b.bunched = n > b.inside / 4
        b.low, b.high, b.inside, b.open = low, high, n, False


def _proposed(df: DataFrame, brackets: list[_Bracket]) -> dict[str, list[float]]:
    sketches = df.agg(
        *[
            F.percentile_approx(b.value(), _around(b.rank / b.inside, b.slack), _ACCURACY).alias(str(i))
            for i, b in enumerate(brackets)
        ]
    ).first()
    return {b.name: sketch for b, sketch in zip(brackets, sketches)}


def _narrow(df: DataFrame, brackets: list[_Bracket], proposals: dict[str, list[float]]) -> None:
    counts = df.agg(
        *[
            F.struct(
                F.count(F.when(b.value() < proposals[b.name][0], True)),
                F.count(F.when(b.value() == proposals[b.name][0], True)),
                F.count(
                    F.when(
                        (b.value() > proposals[b.name][0]) & (b.value() < proposals[b.name][1]), True
                    )
                ),
                F.count(
                    F.when(
                        (b.value() == proposals[b.name][1])
                        & F.lit(proposals[b.name][0] < proposals[b.name][1]),
                        True,
                    )
                ),
            ).alias(str(i))
            for i, b in enumerate(brackets)
        ]
    ).first()
    for b, (below, at_low, between, at_high) in zip(brackets, counts):
        low, high = proposals[b.name]
        rank = b.rank - below
        if 0 < rank <= at_low:
            b.close_on(low)
        elif at_low < rank <= at_low + between:
            b.low, b.high, b.open = low, high, True
            b.rank, b.inside = rank - at_low, between
        elif at_low + between < rank <= at_low + between + at_high:
            b.close_on(high)
        else:
            # The sketch missed: look wider, up to the whole bracket.
            b.slack = min(1.0, b.slack * 4)


def _around(at: float, slack: float) -> list[float]:
    return [max(0.0, at - slack), min(1.0, at + slack)]


def _ranked(df: DataFrame, brackets: list[_Bracket]) -> None:
    values = df.select(*[b.value().alias(f"v{i}") for i, b in enumerate(brackets)])
    # Half a rank below keeps the target clear of rounding.
    picks = [
        F.expr(f"percentile_disc({(b.rank - 0.5) / b.inside!r}D) WITHIN GROUP (ORDER BY v{i})")
        for i, b in enumerate(brackets)
    ]
    for b, value in zip(brackets, values.agg(*picks).first()):
        b.close_on(value)
