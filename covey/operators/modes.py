"""Most frequent values of many columns: sketched in one pass, proved in a second."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covey.functions.columns import column

_CANDIDATES = 8
_TRACKED = 8_192
# Of the values counted, what the sketch may miss of one: it holds a third more places than it
# tracks, at least, and is off by 3.5 times the values over the places. A value that it leaves out
# may have been under by that, and over by that again.
_ERROR = 2 * 3.5 / _TRACKED


def proven_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """The most frequent valid value (of equally frequent ones the smallest) of each column where
    that can be told without counting every value; columns without a heavy one are left out.

    A mergeable sketch of each column proposes a few values and bounds how often any other one can
    occur; these few are then counted exactly. If the most frequent is beyond the bound, it is the
    mode, and all of its equals are among them. Both passes send a row a task.
    """
    sketched = df.agg(
        *[
            F.struct(
                F.count(_valid(c)).alias("n"),
                F.call_function("approx_top_k", _valid(c), F.lit(_CANDIDATES), F.lit(_TRACKED)).alias("top"),
            ).alias(str(i))
            for i, c in enumerate(columns)
        ]
    ).first()
    proposed = {c: got for c, got in zip(columns, sketched) if got["n"] and got["top"]}
    if not proposed:
        return {}
    counted = df.agg(
        *[
            F.array(*[F.count_if(_valid(c) == F.lit(item["item"])) for item in got["top"]]).alias(str(i))
            for i, (c, got) in enumerate(proposed.items())
        ]
    ).first()
    modes = {}
    for (c, got), exact in zip(proposed.items(), counted):
        full = len(got["top"]) == _CANDIDATES
        others = max(got["n"] * _ERROR, got["top"][-1]["count"] if full else 0)
        if max(exact) > others:
            modes[c] = min(item["item"] for item, n in zip(got["top"], exact) if n == max(exact))
    return modes


def _valid(name: str) -> Column:
    v = column(name).cast("double")
    # Adding zero makes -0.0 the 0.0 that it is grouped with.
    return F.when(~F.isnan(v), v + F.lit(0.0))
