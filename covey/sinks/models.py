"""Save and load a fitted model: three ML stages and a manifest beside them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import ImputerModel, StandardScalerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from covey.errors import MissingModel
from covey.operators.preparation import Preparation, imputed
from covey.sinks.files import path_exists, write_json_document

# Directory and file names, and the manifest's fields, of a saved model.
KMEANS_DIR = "kmeans_model"
IMPUTER_DIR = "imputer_model"
SCALER_DIR = "scaler_model"
MANIFEST_FILE = "model_info.json"
MODEL_TYPE = "pyspark.ml.clustering.KMeansModel"
_STRINGS = T.ArrayType(T.StringType())
MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("model_type", T.StringType()),
        T.StructField("best_k", T.IntegerType()),
        T.StructField("best_score", T.DoubleType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("feature_cols", _STRINGS),
        T.StructField("imputed_cols", _STRINGS),
        T.StructField("product_cols", _STRINGS),
        T.StructField("input_path", T.StringType()),
        T.StructField(
            "artifacts",
            T.StructType(
                [
                    T.StructField(KMEANS_DIR, T.StringType()),
                    T.StructField(IMPUTER_DIR, T.StringType()),
                    T.StructField(SCALER_DIR, T.StringType()),
                ]
            ),
        ),
    ]
)


@dataclass(frozen=True)
class FittedModel:
    """What scoring needs: preparation, clusters, and the frozen column lists."""

    preparation: Preparation
    kmeans: KMeansModel
    feature_cols: list[str]
    product_cols: list[str]
    best_k: int
    best_score: float
    metric_name: str = "silhouette"
    input_path: str | None = None


def model_paths(root: str) -> dict[str, str]:
    root = root.rstrip("/")
    return {name: f"{root}/{name}" for name in (KMEANS_DIR, IMPUTER_DIR, SCALER_DIR)}


def manifest_frame(spark: SparkSession, model: FittedModel, root: str) -> DataFrame:
    """The manifest, as a one-row DataFrame with array columns."""
    row = {
        "model_type": MODEL_TYPE,
        "best_k": model.best_k,
        "best_score": model.best_score,
        "metric_name": model.metric_name,
        "feature_cols": model.feature_cols,
        "imputed_cols": imputed(model.feature_cols),
        "product_cols": model.product_cols,
        "input_path": model.input_path,
        "artifacts": model_paths(root),
    }
    return spark.createDataFrame([row], MANIFEST_SCHEMA)


def save_model(spark: SparkSession, model: FittedModel, root: str) -> DataFrame:
    """Overwrite the model under ``root``; returns the manifest."""
    stages = {
        KMEANS_DIR: model.kmeans,
        IMPUTER_DIR: model.preparation.imputer,
        SCALER_DIR: model.preparation.scaler,
    }
    for name, path in model_paths(root).items():
        stages[name].write().overwrite().save(path)
    manifest = manifest_frame(spark, model, root)
    write_json_document(manifest, f"{root.rstrip('/')}/{MANIFEST_FILE}")
    return manifest


def load_model(spark: SparkSession, root: str) -> FittedModel:
    """Fails before any work when there is no manifest under ``root``."""
    manifest_path = f"{root.rstrip('/')}/{MANIFEST_FILE}"
    if not path_exists(spark, manifest_path):
        raise MissingModel(root)
    info = spark.read.schema(MANIFEST_SCHEMA).json(manifest_path, multiLine=True).first()
    # The stages are found under the given root, so that a model directory may be moved.
    paths = model_paths(root)
    features = list(info.feature_cols)
    return FittedModel(
        preparation=Preparation(
            features,
            ImputerModel.load(paths[IMPUTER_DIR]),
            StandardScalerModel.load(paths[SCALER_DIR]),
        ),
        kmeans=KMeansModel.load(paths[KMEANS_DIR]),
        feature_cols=features,
        product_cols=list(info.product_cols),
        best_k=info.best_k,
        best_score=info.best_score,
        metric_name=info.metric_name,
        input_path=info.input_path,
    )
