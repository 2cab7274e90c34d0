"""Train: discover features, prepare a sample, sweep k, report."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from covey.errors import ReservedNames, TooFewRows
from covey.functions.columns import column
from covey.functions.documents import as_documents
from covey.functions.flatten import name_columns
from covey.operators.clustering import (
    PREDICTION,
    canonical_partitions,
    centers_in_original_units,
    sweep,
    training_vectors,
)
from covey.operators.features import align, select_features, select_stored_features
from covey.operators.preparation import RAW_VECTOR, VECTOR, imputed
from covey.operators.profiles import ROWS, cluster_profiles
from covey.operators.sampling import capped_sample
from covey.params import Params
from covey.sinks import collections as names
from covey.sinks.collections import CollectionStore, stamped
from covey.sinks.files import write_csv_parts, write_json_document, write_single_csv
from covey.sinks.models import FittedModel, manifest_frame, save_model
from covey.sources.layout import StoredRows, store_distinct, store_rows
from covey.sources.shared import Run, materialise, scratch
from covey.sources.tables import read_parquet

# The fields of the metrics document.
METRICS_SCHEMA = T.StructType(
    [
        T.StructField("best_k", T.IntegerType()),
        T.StructField("best_score", T.DoubleType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("rows_total", T.LongType()),
        T.StructField("rows_working", T.LongType()),
        T.StructField("features_count", T.IntegerType()),
        T.StructField("features", T.ArrayType(T.StringType())),
    ]
)


@dataclass(frozen=True)
class TrainResult:
    """A fitted model and its reports. Assignments and profiles read a table in the shared folder,
    which ``close()`` removes; used in a ``with`` statement it closes itself."""

    model: FittedModel
    assignments: DataFrame
    profiles: DataFrame
    centers: DataFrame
    metrics: DataFrame
    scores: DataFrame
    run: Run

    def close(self) -> None:
        self.run.close()

    def __enter__(self) -> TrainResult:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


@dataclass(frozen=True)
class TrainingOutputs:
    """Where a training run leaves its results; what is ``None`` is not written. The assignments
    are a directory of parts unless ``clusters_single_file`` asks for one file, which is joined from
    the parts."""

    model_root: str | None = None
    clusters_csv: str | None = None
    profiles_csv: str | None = None
    centers_csv: str | None = None
    metrics_json: str | None = None
    clusters_single_file: bool = False


def train(raw: DataFrame, params: Params = Params()) -> TrainResult:
    """Two scans of ``raw``: one to choose the features, one to take the working rows.
    All that follows runs on the working table."""
    features, total = select_features(raw, params)
    return train_on(raw, features, total, params)


def train_on(
    raw: DataFrame,
    features: list[str],
    total: int,
    params: Params,
    product_cols: list[str] | None = None,
    input_path: str | None = None,
) -> TrainResult:
    """Train on known features of ``raw``, a table of ``total`` rows."""
    if product_cols is None:
        product_cols = list(name_columns(raw.schema, params.name_column))
    taken = {PREDICTION, ROWS, VECTOR, RAW_VECTOR, *imputed(features)}
    if clash := sorted(taken & {*features, *product_cols}):
        raise ReservedNames(clash)
    run = Run(raw.sparkSession)
    try:
        with run.active():
            return _train(raw, features, total, params, product_cols, input_path, run)
    except BaseException:
        run.close()
        raise


def _train(
    raw: DataFrame,
    features: list[str],
    total: int,
    params: Params,
    product_cols: list[str],
    input_path: str | None,
    run: Run,
) -> TrainResult:
    working = working_table(raw, features, product_cols, total, params)
    rows = working.rows().count()
    if rows < params.min_rows:
        raise TooFewRows(rows, params.min_rows)

    preparation, vectors = training_vectors(
        working, features, params.imputer_strategy, params.relative_error
    )
    try:
        found = sweep(vectors, rows, len(features), params)
    finally:
        vectors.unpersist()
    if found.best_model is None:
        raise ValueError("no number of clusters reached a usable score")

    model = FittedModel(
        preparation,
        found.best_model,
        features,
        product_cols,
        found.best_k,
        found.best_score,
        params.metric_name,
        input_path,
    )
    assigned = found.best_model.transform(preparation.transform(working.rows()))
    # Written once: the profiles, the files and the collections all read it from there.
    assignments = materialise(
        assigned.select(
            *[column(c) for c in product_cols], *[column(c) for c in features], PREDICTION
        ),
        "assignments",
    )
    working.drop()
    spark = raw.sparkSession
    metrics = spark.createDataFrame(
        [
            (
                found.best_k,
                found.best_score,
                params.metric_name,
                total,
                rows,
                len(features),
                features,
            )
        ],
        METRICS_SCHEMA,
    )
    return TrainResult(
        model=model,
        assignments=assignments,
        profiles=cluster_profiles(assignments, features, params.profile_decimals),
        centers=centers_in_original_units(
            spark, found.best_model.clusterCenters(), preparation.scaler, features
        ),
        metrics=metrics,
        scores=found.scores,
        run=run,
    )


def working_table(
    raw: DataFrame, features: list[str], product_cols: list[str], total: int, params: Params
) -> StoredRows:
    """Distinct aligned rows, at most ``target_n`` of them, stored in their canonical layout.

    Without a cap that is one shuffle, with one a shuffle of the rows that may be drawn, and one of
    those that are."""
    aligned = align(
        raw, features, product_cols, params.name_column, params.nonfinite_as_null
    )
    if params.target_n is None or total <= params.target_n:
        return store_distinct(aligned, canonical_partitions(total, len(features)))
    # The drawn rows' tables are of no more use once the rows are stored.
    with scratch(raw.sparkSession) as sampling:
        drawn = capped_sample(
            aligned,
            params.target_n,
            params.seed,
            total_rows=total,
            distinct=True,
            method=params.sample_method,
        )
        with sampling.outside():
            return store_rows(drawn, canonical_partitions(drawn.count(), len(features)))


def run_training(
    spark: SparkSession,
    input_path: str,
    outputs: TrainingOutputs = TrainingOutputs(),
    params: Params = Params(),
    store: CollectionStore | None = None,
) -> TrainResult:
    """The whole job: read, optionally keep the input as a collection and train from there,
    write files, model and result collections."""
    raw = read_parquet(spark, input_path)
    features, total = select_stored_features(spark, input_path, params)
    product_cols = list(name_columns(raw.schema, params.name_column))
    source = raw
    if store is not None:
        store.import_table(names.TRAINING_DATA, raw, input_path)
        source = store.read(
            names.TRAINING_DATA,
            features,
            optional=[params.name_column],
            schema=as_documents(raw).schema,
        )

    result = train_on(source, features, total, params, product_cols, input_path)
    _write_files(result, outputs)
    if outputs.model_root is not None:
        manifest = save_model(spark, result.model, outputs.model_root)
    else:
        manifest = manifest_frame(spark, result.model, "")
    if store is not None:
        run_id = utc_now()
        store.replace(names.CLUSTERS, result.assignments)
        store.replace(names.PROFILES, result.profiles)
        store.replace(names.CENTERS, result.centers)
        store.replace(names.METRICS, stamped(result.metrics, run_id))
        store.replace(names.MODEL_INFO, stamped(manifest, run_id))
    return result


def _write_files(result: TrainResult, outputs: TrainingOutputs) -> None:
    if outputs.clusters_csv is not None:
        write = write_single_csv if outputs.clusters_single_file else write_csv_parts
        write(result.assignments, outputs.clusters_csv)
    if outputs.profiles_csv is not None:
        write_single_csv(result.profiles, outputs.profiles_csv)
    if outputs.centers_csv is not None:
        write_single_csv(result.centers, outputs.centers_csv)
    if outputs.metrics_json is not None:
        write_json_document(result.metrics, outputs.metrics_json)


def utc_now() -> str:
    return datetime.now(timezone.utc).isoformat()
