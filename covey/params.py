"""Job parameters, as one immutable object."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The column types that may become features.
# Byte and boolean columns are deliberately not among them.
NUMERIC_TYPES = (
    T.DoubleType,
    T.FloatType,
    T.IntegerType,
    T.LongType,
    T.ShortType,
    T.DecimalType,
)


@dataclass(frozen=True)
class Params:
    """Everything a training or scoring job can be tuned with.

    ``target_n`` caps the rows a model is fitted on; without it all distinct rows are used.
    ``distance_measure`` drives the silhouette only; the fit itself is euclidean.
    ``relative_error`` 0.0 asks for exact medians.
    """

    # Defaults of the published configuration.
    min_non_null_ratio: float = 0.9
    target_n: int | None = None
    imputer_strategy: str = "median"
    k_min: int = 2
    k_max: int = 10
    seed: int = 42
    metric_name: str = "silhouette"
    distance_measure: str = "squaredEuclidean"
    min_rows: int = 10
    profile_decimals: int = 4
    name_column: str = "product_name"
    numeric_types: tuple[type, ...] = NUMERIC_TYPES

    relative_error: float = 0.001
    sample_method: str = "xxhash64"
    nonfinite_as_null: bool = True
    sweep_parallelism: int = 8
