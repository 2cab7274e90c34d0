"""Impute, assemble and standardise features with Spark ML stages."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import (
    Imputer,
    ImputerModel,
    StandardScaler,
    StandardScalerModel,
    VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from covey.functions.columns import column
from covey.operators.medians import exact_lower_medians
from covey.operators.modes import proven_modes

# The names of the derived columns.
IMPUTED_SUFFIX = "_imp"
RAW_VECTOR = "features_raw"
VECTOR = "features"


@dataclass(frozen=True)
class Preparation:
    """Fitted imputer and scaler over ``feature_cols``."""

    feature_cols: list[str]
    imputer: ImputerModel
    scaler: StandardScalerModel

    def transform(self, df: DataFrame) -> DataFrame:
        """Row-local: adds ``<c>_imp``, ``features_raw`` and ``features``."""
        filled = self.imputer.transform(with_stage_columns(df, self.feature_cols))
        return self.scaler.transform(assemble(filled, self.feature_cols))


def stage_columns(columns: Sequence[str]) -> list[str]:
    """The names ML stages know the columns by: their own, unless a stage would read the name as
    a path into a struct. Names made up for those differ from all of the columns' own."""
    prefix = "feature_"
    while any(c.startswith(prefix) for c in columns):
        prefix += "_"
    return [f"{prefix}{i}" if "." in c or "`" in c else c for i, c in enumerate(columns)]


def with_stage_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    renamed = {s: column(c) for s, c in zip(stage_columns(columns), columns) if s != c}
    return df.withColumns(renamed) if renamed else df


def imputed(columns: Sequence[str]) -> list[str]:
    return [c + IMPUTED_SUFFIX for c in stage_columns(columns)]


def fit_imputer(
    df: DataFrame,
    columns: Sequence[str],
    strategy: str = "median",
    relative_error: float = 0.001,
) -> ImputerModel:
    """Mean, mode or median of the valid (not null, not NaN) values of every column.

    A median within ``relative_error`` comes from mergeable sketches. Spark's own exact setting
    would gather whole columns, so ``relative_error=0`` takes exact medians by another route and
    fits the same stage on the one row of them. Modes are proved from a sketch where a value is
    frequent enough; only the other columns are shuffled by value.
    """
    df = with_stage_columns(df, columns)
    names, outputs = stage_columns(columns), imputed(columns)
    if strategy == "median" and relative_error == 0:
        return _known(df, names, outputs, exact_lower_medians(df, names), strategy)
    if strategy == "mode":
        modes = proven_modes(df, names)
        if rest := [c for c in names if c not in modes]:
            counted = Imputer(strategy=strategy, inputCols=rest, outputCols=imputed(rest)).fit(df)
            modes |= counted.surrogateDF.first().asDict()
        return _known(df, names, outputs, modes, strategy)
    return Imputer(
        strategy=strategy,
        relativeError=relative_error,
        inputCols=names,
        outputCols=outputs,
    ).fit(df)


def _known(
    df: DataFrame,
    names: list[str],
    outputs: list[str],
    surrogates: dict[str, float | None],
    strategy: str,
) -> ImputerModel:
    """The stage's model for surrogates found otherwise: fitted on the one row of them."""
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in names])
    row = [math.nan if surrogates[c] is None else float(surrogates[c]) for c in names]
    model = Imputer(strategy="mean", inputCols=names, outputCols=outputs).fit(
        df.sparkSession.createDataFrame([row], schema)
    )
    model.set(model.strategy, strategy)
    model.set(model.relativeError, 0.0)
    return model


def assemble(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The imputed columns as one dense vector; a null left in them is an error."""
    return VectorAssembler(inputCols=imputed(columns), outputCol=RAW_VECTOR).transform(df)


def fit_scaler(df: DataFrame) -> StandardScalerModel:
    """Mean 0 and unit sample deviation per slot; a constant slot becomes 0."""
    return StandardScaler(
        inputCol=RAW_VECTOR, outputCol=VECTOR, withMean=True, withStd=True
    ).fit(df)


def fit_preparation(
    df: DataFrame,
    columns: Sequence[str],
    strategy: str = "median",
    relative_error: float = 0.001,
) -> Preparation:
    """Two passes over ``df``: one for the surrogates, one for the scaling."""
    imputer = fit_imputer(df, columns, strategy, relative_error)
    filled = imputer.transform(with_stage_columns(df, columns))
    scaler = fit_scaler(assemble(filled, columns))
    return Preparation(list(columns), imputer, scaler)
