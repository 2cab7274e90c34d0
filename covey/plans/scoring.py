"""Score: bring a table to a model's columns, assign clusters, summarise."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from covey.functions.columns import column
from covey.operators.clustering import PREDICTION
from covey.operators.features import align
from covey.operators.profiles import prediction_summary
from covey.operators.sampling import distinct_rows
from covey.params import Params
from covey.plans.training import utc_now
from covey.sinks import collections as names
from covey.sinks.collections import CollectionStore
from covey.sinks.files import write_csv_parts, write_single_csv
from covey.sinks.models import FittedModel, load_model
from covey.sources.tables import read_parquet


def score(
    raw: DataFrame, model: FittedModel, deduplicate: bool = True, params: Params = Params()
) -> DataFrame:
    """Names, features and cluster of every distinct row (of every row without
    ``deduplicate``). One shuffle at most, for the duplicates; the rest is row-local."""
    rows = align(
        raw,
        model.feature_cols,
        model.product_cols,
        params.name_column,
        params.nonfinite_as_null,
    )
    if deduplicate:
        rows = distinct_rows(rows)
    assigned = model.kmeans.transform(model.preparation.transform(rows))
    kept = [column(c) for c in (*model.product_cols, *model.feature_cols)]
    return assigned.select(*kept, PREDICTION)


def run_scoring(
    spark: SparkSession,
    model_root: str,
    input_path: str,
    output_path: str,
    store: CollectionStore | None = None,
    deduplicate: bool = True,
    single_file: bool = False,
    params: Params = Params(),
) -> dict:
    """Score a Parquet table into CSV and return the run's summary.

    Predictions grow with the input, so they are written as parts in parallel;
    ``single_file=True`` joins the parts into one file. The rows are computed once: clusters are
    counted by the tasks that write them.
    """
    model = load_model(spark, model_root)
    predictions = score(read_parquet(spark, input_path), model, deduplicate, params)
    clusters = range(len(model.kmeans.clusterCenters()))
    seen = Observation("clusters")
    observed = predictions.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(PREDICTION) == i).alias(str(i)) for i in clusters],
    )
    if single_file:
        write_single_csv(observed, output_path)
    else:
        write_csv_parts(observed, output_path)
    counted = seen.get
    counts = spark.createDataFrame(
        [(i, counted[str(i)]) for i in clusters if counted[str(i)]],
        f"{PREDICTION} int, count long",
    )
    summary = prediction_summary(counts, utc_now(), model_root, input_path, output_path)
    if store is not None:
        store.append(names.PREDICTION_SUMMARY, summary)
    return summary.first().asDict(recursive=True)
