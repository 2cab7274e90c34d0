"""Per-cluster summaries of assigned rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covey.functions.columns import column
from covey.operators.clustering import PREDICTION


# Fixed value: the column that counts a cluster's rows.
ROWS = "n"


def cluster_profiles(
    assigned: DataFrame, features: Sequence[str], decimals: int = 4
) -> DataFrame:
    """Rows and rounded feature means per cluster, over the features as they came in (nulls
    skipped), not over imputed values. Partial sums leave one row per task and cluster."""
    means = [F.round(F.avg(column(c)), decimals).alias(c) for c in features]
    return (
        assigned.groupBy(PREDICTION).agg(F.count("*").alias(ROWS), *means).orderBy(PREDICTION)
    )


def prediction_counts(assigned: DataFrame) -> DataFrame:
    """Rows per cluster, by cluster."""
    return assigned.groupBy(PREDICTION).count().orderBy(PREDICTION)


def prediction_summary(
    counts: DataFrame, run_id: str, model_path: str, input_path: str, output_path: str
) -> DataFrame:
    """The one-row summary of a scoring run, from its per-cluster counts (at most k rows)."""
    cluster = F.struct(PREDICTION, "count")
    return counts.agg(
        # The fields of the summary.
        F.lit(run_id).alias("run_id"),
        F.lit(run_id).alias("created_at"),
        F.lit(model_path).alias("model_path"),
        F.lit(input_path).alias("input_path"),
        F.lit(output_path).alias("output_path"),
        F.coalesce(F.sum("count"), F.lit(0)).alias("rows"),
        F.array_sort(F.collect_list(cluster)).alias("clusters"),
    )
