"""KMeans fits, the sweep over k, and what follows from centres."""

from __future__ import annotations

import functools
import math
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScalerModel
from pyspark.mllib.common import _py2java
from pyspark.mllib.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covey.errors import TooFewRowsForSweep
from covey.functions.columns import column
from covey.operators.lloyd import first_centers, iterate, mean_silhouette, packed, plan_packing
from covey.operators.preparation import VECTOR, Preparation, fit_preparation
from covey.params import Params
from covey.sources.layout import StoredRows

PREDICTION = "prediction"
# Numbers in a partition: 128 MB of them, but up to 64 partitions while these would be smaller.
_CELLS_PER_PARTITION = 16_000_000
_CELLS_AT_LEAST = 200_000
_SMALL_PARTITIONS = 64


def canonical_partitions(rows: int, width: int) -> int:
    """Buckets of a fit's stored rows: from the data's size alone, not the cluster's, so that a
    seed gives the same model everywhere."""
    cells = rows * width
    small = min(_SMALL_PARTITIONS, math.ceil(cells / _CELLS_AT_LEAST))
    return max(1, small, math.ceil(cells / _CELLS_PER_PARTITION))


def training_vectors(
    stored: StoredRows, columns: Sequence[str], strategy: str, relative_error: float
) -> tuple[Preparation, DataFrame]:
    """Fit the preparation on the stored rows, in their layout; the vectors to cluster, persisted in
    that layout. A lost partition comes back from its bucket, without a shuffle."""
    with stored.in_layout() as rows:
        chosen = rows.select(*[column(c) for c in columns])
        preparation = fit_preparation(chosen, columns, strategy, relative_error)
        vectors = preparation.transform(chosen).select(VECTOR)
        plan_packing(vectors, VECTOR)
        return preparation, vectors.persist(StorageLevel.MEMORY_AND_DISK)


def fit_kmeans(vectors: DataFrame, k: int, seed: int) -> KMeansModel:
    """Spark ML's k-means over the vectors packed as matrices, which all fits within one ``packed``
    share. The same random numbers and rules as the estimator's own fit, so the same centres but
    for the rounding of sums."""
    estimator = KMeans(featuresCol=VECTOR, predictionCol=PREDICTION, k=k, seed=seed, solver="block")
    with packed(vectors, VECTOR) as rows:
        first = first_centers(rows, k, seed, estimator.getInitSteps())
        centers = iterate(rows.blocks, first, estimator.getTol(), estimator.getMaxIter())
    return _model_of(estimator, centers, vectors.sparkSession)


def _model_of(estimator: KMeans, centers: np.ndarray, spark: SparkSession) -> KMeansModel:
    """Spark ML's model for centres found otherwise."""
    jvm = spark.sparkContext._jvm
    found = _py2java(spark.sparkContext, [Vectors.dense(center) for center in centers])
    known = jvm.org.apache.spark.mllib.clustering.KMeansModel(found)
    model = KMeansModel(jvm.org.apache.spark.ml.clustering.KMeansModel(estimator.uid, known))
    return estimator._copyValues(model)


def silhouette(
    assigned: DataFrame,
    features: str = VECTOR,
    prediction: str = PREDICTION,
    metric_name: str = "silhouette",
    distance_measure: str = "squaredEuclidean",
) -> float:
    """Mean silhouette, from per-cluster sums: linear in the rows, no pair of rows is formed.
    NaN when only one cluster has rows."""
    evaluator = ClusteringEvaluator(
        featuresCol=features,
        predictionCol=prediction,
        metricName=metric_name,
        distanceMeasure=distance_measure,
    )
    try:
        return evaluator.evaluate(assigned)
    except Exception as error:
        if "Number of clusters must be greater than one" in str(error):
            return math.nan
        raise


def silhouette_of(model: KMeansModel, vectors: DataFrame, metric_name: str, distance_measure: str) -> float:
    """``silhouette`` of a model's own clusters. Of squared distances it is taken over the packed
    vectors, of other ones by the evaluator."""
    if (metric_name, distance_measure) != ("silhouette", "squaredEuclidean"):
        return silhouette(
            model.transform(vectors), metric_name=metric_name, distance_measure=distance_measure
        )
    with packed(vectors, VECTOR) as rows:
        return mean_silhouette(rows.blocks, np.array(model.clusterCenters()))


@dataclass(frozen=True)
class Sweep:
    """Every score, the model that won (``None`` when no score beats the floor), and the ids of
    the Spark jobs that each k took."""

    scores: DataFrame
    best_k: int | None
    best_score: float | None
    best_model: KMeansModel | None
    jobs: dict[int, list[int]]


# Fixed value: a score has to be above this to win.
SCORE_FLOOR = -1.0


def best_of(scores: DataFrame) -> DataFrame:
    """The ``(k, score)`` row with the largest score; of equal scores, the smallest k.
    NaN is taken out first, as it sorts above every number."""
    return (
        scores.where(~F.isnan("score") & (F.col("score") > SCORE_FLOOR))
        .orderBy(F.desc("score"), F.asc("k"))
        .limit(1)
    )


def sweep(vectors: DataFrame, rows: int, width: int, params: Params) -> Sweep:
    """Fit and score every k from ``k_min`` to ``min(k_max, rows - 1)``.

    The vectors are persisted once for all fits, unless they are already. Fits are independent, so
    some run at a time, each under its own job group, as long as one fit has too few tasks to fill
    the cluster. On data with more partitions than that they run one by one; that changes the time,
    not the results. All jobs carry the sweep's tag: when a fit fails, the others are cancelled.
    """
    k_max = min(params.k_max, rows - 1)
    if k_max < params.k_min:
        raise TooFewRowsForSweep(rows, params.k_min)
    # The largest k takes longest, so it starts first.
    ks = range(k_max, params.k_min - 1, -1)
    spark, tag = vectors.sparkSession, f"kmeans-sweep-{uuid.uuid4().hex}"
    own = vectors.storageLevel == StorageLevel.NONE
    if own:
        vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    # Wrapped one by one: each wrap copies the local properties, job group among them.
    fits = [
        inheritable_thread_target(spark)(functools.partial(_fit_and_score, vectors, params, k, tag))
        for k in ks
    ]
    try:
        with packed(vectors, VECTOR):
            results = _all_or_cancel(
                spark, tag, fits, _fits_at_a_time(spark, rows, width, len(ks), params)
            )
    finally:
        if own:
            vectors.unpersist()
    results.sort(key=lambda r: r[0])
    models = {k: model for k, model, _, _ in results}
    jobs = {k: ids for k, _, _, ids in results}
    scores = spark.createDataFrame([(k, score) for k, _, score, _ in results], "k int, score double")
    best = best_of(scores).first()
    if best is None:
        return Sweep(scores, None, None, None, jobs)
    return Sweep(scores, best.k, best.score, models[best.k], jobs)


def _all_or_cancel(spark: SparkSession, tag: str, fits: Sequence[Callable], at_a_time: int) -> list:
    """Every result; at the first failure the jobs under way are cancelled, no other starts, and
    that failure is raised."""
    with ThreadPoolExecutor(at_a_time) as pool:
        waiting = [pool.submit(fit) for fit in fits]
        done, _ = wait(waiting, return_when=FIRST_EXCEPTION)
        failed = next((f.exception() for f in waiting if f in done and f.exception()), None)
        if failed is not None:
            for future in waiting:
                future.cancel()
            # A fit between two jobs starts another one, so until all have ended.
            while wait(waiting, timeout=0.2).not_done:
                spark.sparkContext.cancelJobsWithTag(tag)
            raise failed
    return [future.result() for future in waiting]


def _fits_at_a_time(
    spark: SparkSession, rows: int, width: int, fits: int, params: Params
) -> int:
    # A few tasks per core keep the cores busy between the short stages of an iteration.
    room = 4 * spark.sparkContext.defaultParallelism // canonical_partitions(rows, width)
    return max(1, min(params.sweep_parallelism, fits, room))


def _fit_and_score(
    vectors: DataFrame, params: Params, k: int, tag: str
) -> tuple[int, KMeansModel, float, list[int]]:
    context = vectors.sparkSession.sparkContext
    # The group's name is a fixed value.
    group = f"kmeans-k-{k}"
    context.setJobGroup(group, f"{k} clusters: model and score")
    context.addJobTag(tag)
    earlier = set(context.statusTracker().getJobIdsForGroup(group))
    model = fit_kmeans(vectors, k, params.seed)
    score = silhouette_of(model, vectors, params.metric_name, params.distance_measure)
    jobs = sorted(set(context.statusTracker().getJobIdsForGroup(group)) - earlier)
    return k, model, score, jobs


def centers_in_original_units(
    spark: SparkSession,
    centers: Sequence[Sequence[float]],
    scaler: StandardScalerModel,
    features: Sequence[str],
) -> DataFrame:
    """Every cluster's centre as a row of the features' own units: the scaling undone by column
    arithmetic. At most k rows; columns are sorted by name."""
    numbered = [(i, [float(x) for x in center]) for i, center in enumerate(centers)]
    scaled = spark.createDataFrame(numbered, f"{PREDICTION} int, z array<double>")
    units = {
        name: F.col("z")[i] * F.lit(float(scaler.std[i])) + F.lit(float(scaler.mean[i]))
        for i, name in enumerate(features)
    }
    units[PREDICTION] = F.col(PREDICTION)
    return scaled.orderBy(PREDICTION).select(*[units[name].alias(name) for name in sorted(units)])
