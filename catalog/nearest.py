"""The nearest of given centres by plain column arithmetic: what models are checked against."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covey.functions.columns import column
from covey.operators.clustering import PREDICTION


def nearest_center(features: Sequence[str], centers: Sequence[Sequence[float]]) -> Column:
    """Index of the nearest of a few given centres; of equally near ones, the first.
    Plain arithmetic on the row, compiled with the rest of the stage."""
    ranked = [
        F.struct(_squared_distance(features, center).alias("d"), F.lit(i).alias("i"))
        for i, center in enumerate(centers)
    ]
    return F.array_min(F.array(*ranked)).getField("i")


def _squared_distance(features: Sequence[str], center: Sequence[float]) -> Column:
    offsets = [column(name) - F.lit(float(at)) for name, at in zip(features, center, strict=True)]
    return functools.reduce(Column.__add__, [o * o for o in offsets])


def assign_to_centers(
    df: DataFrame, features: Sequence[str], centers: Sequence[Sequence[float]]
) -> DataFrame:
    return df.withColumn(PREDICTION, nearest_center(features, centers))
