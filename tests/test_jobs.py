"""Fits, sweeps and whole jobs: invariants, edge cases, and what lands on disk."""

import json
import math
import time

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from catalog import nearest
from covey import Params, TrainingOutputs, errors, run_scoring, run_training, score, train
from covey.functions import xorshift
from covey.functions.flatten import name_columns
from covey.operators import clustering, lloyd, preparation, profiles
from covey.operators.features import select_features
from covey.plans import training
from covey.plans.wordcount import word_count_job
from covey.sinks.collections import CollectionStore
from covey.sinks.models import load_model, save_model
from covey.sources import layout, shared

PARAMS = Params(k_max=4)


@pytest.fixture(scope="module")
def products(spark):
    """Two far groups of 200 and 400, nested names, gaps, duplicates, columns that must not be features."""
    rows = spark.range(600).selectExpr(
        "array(named_struct('lang', 'en', 'text', concat('p', id)),"
        " named_struct('lang', 'fr', 'text', CAST(NULL AS STRING))) AS product_name",
        "CASE WHEN id % 30 <> 1 THEN CAST(sign(id % 3) * 1000 + id % 7 AS INT) END AS size",
        "CAST(sign(id % 3) * 100 + id % 11 AS DECIMAL(9, 2)) AS price",
        "CAST(id % 3 AS TINYINT) AS tiny",
        "1.5D AS constant",
        "CASE WHEN id < 300 THEN id END AS sparse",
    )
    return rows.union(rows.limit(100))


@pytest.fixture(scope="module")
def products_path(products, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("in") / "products.parquet")
    products.write.parquet(path)
    return path


@pytest.fixture(scope="module")
def result(products):
    return train(products, PARAMS)


def test_train_finds_the_groups(result):
    assert result.model.feature_cols == ["size", "price"]
    assert result.model.product_cols == ["product_name_langs", "product_name_texts"]
    assert result.model.best_k == 2
    metrics = result.metrics.first()
    assert (metrics.rows_total, metrics.rows_working) == (700, 600)
    assert metrics.features == ["size", "price"]


def test_profiles_centers_and_assignments_agree(result):
    sizes = [r.n for r in result.profiles.collect()]
    assert sum(sizes) == result.assignments.count() == 600
    assert len(sizes) == result.centers.count() == result.model.best_k
    assert result.assignments.columns == [
        "product_name_langs",
        "product_name_texts",
        "size",
        "price",
        "prediction",
    ]
    assert result.centers.columns == sorted(["prediction", "size", "price"])


def test_profiles_skip_nulls_but_centers_do_not(result):
    """A feature without gaps has the same mean in both, one with gaps does not."""
    profile = {r.prediction: r for r in result.profiles.collect()}
    center = {r.prediction: r for r in result.centers.collect()}
    moved = []
    for i, row in profile.items():
        assert row.price == pytest.approx(center[i].price, abs=1e-3)
        moved.append(abs(row.size - center[i].size) > 1e-2)
    assert any(moved)


def test_training_is_reproducible(products, result):
    again = train(products.repartition(5), PARAMS).model
    for a, b in zip(result.model.kmeans.clusterCenters(), again.kmeans.clusterCenters()):
        assert np.array_equal(a, b)
    assert again.best_score == result.model.best_score


def test_nothing_stays_cached(spark, products):
    spark.catalog.clearCache()
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    train(products, PARAMS)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_target_n_caps_the_working_rows(products):
    metrics = train(products, Params(k_max=2, target_n=150)).metrics.first()
    assert (metrics.rows_total, metrics.rows_working) == (700, 150)
    assert train(products, Params(k_max=2, target_n=None)).metrics.first().rows_working == 600


def test_names_that_look_like_paths(spark, products, tmp_path):
    odd = products.selectExpr("product_name", "size AS `a.b`", "price AS `c``d`", "size AS `e f`")
    trained = train(odd, Params(k_max=2, relative_error=0.0))
    assert trained.profiles.columns == ["prediction", "n", "a.b", "c`d", "e f"]
    save_model(spark, trained.model, str(tmp_path / "m"))
    scored = score(odd, load_model(spark, str(tmp_path / "m")))
    assert sorted(map(str, scored.collect())) == sorted(map(str, trained.assignments.collect()))


def test_every_k_has_its_job_group(spark, products):
    train(products, PARAMS)
    for k in (2, 3, 4):
        assert spark.sparkContext.statusTracker().getJobIdsForGroup(f"kmeans-k-{k}")
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None


def test_too_few_rows(spark, products):
    with pytest.raises(errors.TooFewRows):
        train(products, Params(target_n=9))
    assert train(products, Params(target_n=10, k_max=2)).metrics.first().rows_working == 10


def test_sweep_needs_more_rows_than_clusters(spark):
    with pytest.raises(errors.TooFewRowsForSweep):
        clustering.sweep(spark.range(0), 10, 1, Params(k_min=10, k_max=20))


def test_k_is_capped_by_the_rows(spark):
    df = spark.range(12).select(F.col("id").cast("double").alias("x"))
    scores = train(df, Params(k_min=9, k_max=30)).scores
    assert [r.k for r in scores.orderBy("k").collect()] == [9, 10, 11]


@pytest.mark.parametrize(
    "scores, k",
    [
        ([(2, 0.5), (3, math.nan), (4, 0.5)], 2),
        ([(2, 0.1), (3, 0.4), (4, 0.2)], 3),
        ([(2, math.nan), (3, -1.0)], None),
    ],
)
def test_best_of(spark, scores, k):
    best = clustering.best_of(spark.createDataFrame(scores, "k int, score double")).first()
    assert (best.k if best else None) == k


def test_silhouette_of_one_cluster_is_nan(spark):
    df = spark.createDataFrame([(Vectors.dense([float(i)]), 0) for i in range(5)], ["features", "prediction"])
    assert math.isnan(clustering.silhouette(df))


def test_other_distance(products):
    assert train(products, Params(k_max=2, distance_measure="cosine")).model.best_score > 0


@pytest.mark.parametrize("strategy, expected", [("median", 2.0), ("mean", 2.5), ("mode", 1.0)])
@pytest.mark.parametrize("relative_error", [0.0, 0.001])
def test_imputer(spark, strategy, expected, relative_error):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 4.0, None, float("nan"))], "x double")
    model = preparation.fit_imputer(df, ["x"], strategy, relative_error)
    assert model.surrogateDF.first().x == expected
    assert [r.x_imp for r in model.transform(df).collect()][4:] == [expected, expected]


@pytest.mark.parametrize("relative_error", [0.0, 0.001])
def test_imputer_needs_a_value(spark, relative_error):
    df = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    with pytest.raises(Exception, match="surrogate cannot be computed"):
        preparation.fit_imputer(df, ["x"], "median", relative_error)


def test_constant_slot_scales_to_zero(spark):
    df = spark.createDataFrame([(1.0, float(i)) for i in range(5)], "a double, b double")
    fitted = preparation.fit_preparation(df, ["a", "b"])
    assert {r.features[0] for r in fitted.transform(df).collect()} == {0.0}


def test_nearest_center_prefers_the_first(spark):
    df = spark.createDataFrame([(5.0,), (1.0,), (9.0,)], "x double")
    out = nearest.assign_to_centers(df, ["x"], [(0.0,), (10.0,)])
    assert [r.prediction for r in out.collect()] == [0, 0, 1]


def test_scoring_frame(products, result):
    scored = score(products.drop("price"), result.model)
    assert scored.columns == result.assignments.columns
    assert scored.count() == 600
    assert scored.where("price IS NOT NULL").isEmpty()
    assert score(products, result.model, deduplicate=False).count() == 700


def test_scoring_shuffles_once_at_most(products_path, spark, result):
    raw = spark.read.parquet(products_path)
    plan = score(raw, result.model)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    plan = score(raw, result.model, deduplicate=False)._jdf.queryExecution().executedPlan()
    assert "Exchange" not in plan.toString()
    # Only what the model needs is read.
    assert "tiny" not in plan.toString()


def test_whole_job(spark, products_path, tmp_path):
    root = str(tmp_path)
    store = CollectionStore(spark, f"{root}/store")
    outputs = TrainingOutputs(
        f"{root}/model",
        f"{root}/clusters.csv",
        f"{root}/profiles.csv",
        f"{root}/centers.csv",
        f"{root}/metrics.json",
        clusters_single_file=True,
    )
    trained = run_training(spark, products_path, outputs, PARAMS, store)
    assert trained.model.best_k == 2

    header = (tmp_path / "clusters.csv").read_text(encoding="utf-8").splitlines()
    assert header[0] == "product_name_langs,product_name_texts,size,price,prediction"
    assert len(header) == 601
    assert (tmp_path / "profiles.csv").read_text().startswith("prediction,n,size,price\n")
    assert (tmp_path / "centers.csv").read_text().startswith("prediction,price,size\n")
    metrics = json.loads((tmp_path / "metrics.json").read_text(encoding="utf-8"))
    assert metrics["best_k"] == 2 and metrics["features"] == ["size", "price"]
    manifest = json.loads((tmp_path / "model" / "model_info.json").read_text(encoding="utf-8"))
    assert manifest["imputed_cols"] == ["size_imp", "price_imp"]
    assert manifest["artifacts"]["kmeans_model"] == f"{root}/model/kmeans_model"

    assert store.read("imports").first().rows == 700
    run_ids = {store.read(n).first().run_id for n in ("training_metrics", "model_info")}
    assert len(run_ids) == 1
    assert store.read("training_clusters").count() == 600

    # Twice, into the same places: outputs are replaced, the summary is appended.
    for _ in range(2):
        summary = run_scoring(
            spark, f"{root}/model", products_path, f"{root}/out.csv", store, single_file=True
        )
    assert summary["rows"] == 600
    assert sum(c["count"] for c in summary["clusters"]) == 600
    assert set(summary) == {
        "run_id", "created_at", "model_path", "input_path", "output_path", "rows", "clusters"
    }
    assert len((tmp_path / "out.csv").read_text().splitlines()) == 601
    assert store.read("prediction_summary").count() == 2
    parts = run_scoring(spark, f"{root}/model", products_path, f"{root}/parts", store)
    assert parts["clusters"] == summary["clusters"]
    assert spark.read.csv(f"{root}/parts", header=True).count() == 600
    assert [p.name for p in tmp_path.iterdir() if p.name.startswith("_")] == []


def test_summary_matches_a_recount(spark, products, result):
    counts = profiles.prediction_counts(score(products, result.model))
    summary = profiles.prediction_summary(counts, "r", "m", "i", "o").first()
    assert summary.rows == 600
    assert [c.prediction for c in summary.clusters] == [0, 1]


def test_missing_model_fails_early(spark, tmp_path):
    with pytest.raises(errors.MissingModel):
        load_model(spark, str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_word_count_job(spark, tmp_path):
    path = tmp_path / "lines.txt"
    path.write_text("hello spark\nhello world\nspark world spark\n", encoding="utf-8")
    rows = word_count_job(spark, str(path)).collect()
    assert [tuple(r) for r in rows] == [("hello", 2), ("spark", 3), ("world", 2)]


def test_words_split_as_python_does(spark, tmp_path):
    text = "a b c 　d\u001ce\tf  g\u0085h ​i"
    path = tmp_path / "lines.txt"
    path.write_text(text + "\n\n   \n", encoding="utf-8")
    got = {r.word for r in word_count_job(spark, str(path)).collect()}
    assert got == set(text.split())


@pytest.mark.parametrize(
    "sql",
    [
        "CAST(id % 2 AS DOUBLE)",
        "CAST(id % 50 + 1 AS DOUBLE)",
        "IF(id < 49990, 1.0D, 2.0D)",
        "IF(id < 50010, 1.0D, 2.0D)",
        "CAST(id % 3 AS DOUBLE) - 1e-3",
    ],
)
def test_exact_medians_of_heavy_values(spark, sql):
    from covey.operators.medians import exact_lower_medians

    rows = spark.range(100_000).selectExpr(f"{sql} AS v")
    values = sorted(r.v for r in rows.collect())
    assert exact_lower_medians(rows, ["v"]) == {"v": values[(len(values) - 1) // 2]}


def test_names_that_results_need_are_refused(spark):
    from covey.errors import ReservedNames

    rows = spark.range(100).selectExpr("CAST(id AS DOUBLE) AS n", "CAST(id % 7 AS DOUBLE) AS x")
    with pytest.raises(ReservedNames):
        train(rows, Params(k_max=2))


def test_partitions_grow_with_the_data_only_so_far():
    assert clustering.canonical_partitions(1_000, 4) == 1
    assert clustering.canonical_partitions(600_000, 8) == 24
    assert clustering.canonical_partitions(10**11, 100) == 625_000


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_one_shuffle_from_working_rows_to_the_fit(spark, products_path, monkeypatch):
    """The duplicates' shuffle makes the layout; what follows reads the buckets as they are."""
    products, plans = spark.read.parquet(products_path), []
    stored = layout._stored

    def watched(df, partitions):
        with shared.settings(spark, {"spark.sql.adaptive.enabled": "false"}):
            plans.append((_shuffles(df), partitions))
        return stored(df, partitions)

    monkeypatch.setattr(layout, "_stored", watched)
    features, total = select_features(products, PARAMS)
    names = list(name_columns(products.schema, PARAMS.name_column))
    working = training.working_table(products, features, names, total, PARAMS)
    assert plans == [(1, clustering.canonical_partitions(total, len(features)))]
    assert len(spark.read.parquet(working.path).inputFiles()) == plans[0][1]
    with working.in_layout() as rows:
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
    _, vectors = clustering.training_vectors(working, features, "median", 0.001)
    assert _shuffles(vectors) == 0
    assert vectors.rdd.getNumPartitions() == plans[0][1]
    vectors.unpersist()
    working.drop()


def test_layout_is_the_same_whatever_the_input_layout(spark):
    rows = [(f"p{i}", float(i % 50)) for i in range(2_000)] + [(None, math.nan), (None, -0.0), (None, 0.0), ("", None)] * 40
    df = spark.createDataFrame(rows, "`a.b` STRING, `x``y` DOUBLE")

    def parts(frame):
        stored = layout.store_distinct(frame, 7)
        with stored.in_layout() as read:
            assert read.columns == df.columns
            got = read.rdd.mapPartitions(lambda part: [[repr(tuple(r)) for r in part]]).collect()
        stored.drop()
        return got

    one = parts(df)
    assert len(one) == 7 and sum(map(len, one)) == 2_003
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with shared.settings(spark, {"spark.sql.shuffle.partitions": "3"}):
        assert parts(df.repartition(11, "`a.b`")) == one
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert parts(df.orderBy("`x``y`")) == one
    # Dealt by all columns already, so that removing duplicates needs no shuffle.
    assert parts(df.repartition(5, "`a.b`", "`x``y`")) == one


def test_a_run_leaves_nothing_behind(spark, products, tmp_path, monkeypatch):
    folder = tmp_path / "covey"
    monkeypatch.setattr(shared, "shared_dir", lambda _: str(tmp_path))
    for params in (PARAMS, Params(k_max=3, target_n=100)):
        with train(products, params) as trained:
            assert trained.assignments.count() == (params.target_n or 600)
            # Of all that was written only the assignments are still there.
            assert [p.name.split("-")[0] for p in folder.iterdir()] == ["assignments"]
        assert list(folder.iterdir()) == []
    with pytest.raises(errors.GuardError):
        train(products.limit(5), PARAMS)
    with shared.scratch(spark):
        shared.materialise(spark.range(3), "mine")
        assert len(list(folder.iterdir())) == 1
    assert list(folder.iterdir()) == []
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("covey_rows")]


def test_a_failing_fit_cancels_the_others(spark, monkeypatch):
    vectors = spark.createDataFrame([(Vectors.dense([float(i % 40)]),) for i in range(400)], ["features"])
    slow, broken = 4, 3
    ended = []

    def fit(df, k, seed):
        if k == slow:
            sleeping = F.udf(lambda x: time.sleep(60) or 1, "int")
            try:
                spark.range(4).select(F.sum(sleeping("id"))).collect()
            except Exception as error:
                ended.append(str(error))
                raise
        if k == broken:
            time.sleep(3)
            raise ValueError("broken fit")

    monkeypatch.setattr(clustering, "fit_kmeans", fit)
    started = time.monotonic()
    with pytest.raises(ValueError, match="broken fit"):
        clustering.sweep(vectors, 400, 1, Params(k_min=3, k_max=4))
    assert time.monotonic() - started < 40
    assert len(ended) == 1


def test_each_k_has_jobs_of_its_own(spark):
    vectors = spark.createDataFrame([(Vectors.dense([float(i % 40)]),) for i in range(400)], ["features"])
    jobs = clustering.sweep(vectors, 400, 1, Params(k_max=4)).jobs
    assert sorted(jobs) == [2, 3, 4] and all(jobs.values())
    assert len({j for ids in jobs.values() for j in ids}) == sum(map(len, jobs.values()))


def test_rows_of_many_columns_are_stored_once(spark, monkeypatch):
    """Spark shuffles a distinct by many columns in an order of its own: rows were then dealt over
    all buckets by every task, and stored again."""
    calls, stored = [], layout._stored
    monkeypatch.setattr(layout, "_stored", lambda *given: calls.append(1) or stored(*given))
    names = [f"x{i}" for i in range(8)]
    rows = spark.range(600).selectExpr(*[f"CAST(id % 300 * {i + 1} % 17 AS DOUBLE) + id % 300 AS {n}" for i, n in enumerate(names)])
    kept = layout.store_distinct(rows, 5)
    assert len(calls) == 1
    assert sorted(map(tuple, kept.rows().collect())) == sorted(set(map(tuple, rows.collect())))


def test_a_fit_by_blocks_is_the_fit_by_rows(spark, monkeypatch):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    columns = ["CAST(id % 3 * 50 + id % 7 AS DOUBLE) AS a", "CAST(id * 31 % 101 AS DOUBLE) / 10 AS b"]
    rows = spark.range(0, 3_000, 1, 3).selectExpr(*columns)
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    made = []
    monkeypatch.setattr(clustering, "KMeans", lambda **given: made.append(KMeans(**given)) or made[-1])
    model = clustering.fit_kmeans(vectors, 3, 42)
    assert made[0].getSolver() == "block"
    by_rows = KMeans(k=3, seed=42, solver="row").fit(vectors)
    for got, expected in zip(model.clusterCenters(), by_rows.clusterCenters(), strict=True):
        assert list(got) == pytest.approx(list(expected), abs=1e-9)


def test_a_fit_starts_and_ends_as_the_library_s(spark):
    """The same first centres and as many rows in every cluster, for rows in uneven partitions."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    columns = ["CAST(id * 7919 % 1001 AS DOUBLE) / 100 AS a", "CAST(id * 31 % 101 AS DOUBLE) / 10 AS b", "id % 7 - 3.0D AS c"]
    rows = spark.range(0, 60_000, 1, 5).where("id NOT BETWEEN 9000 AND 30000").selectExpr(*columns)
    vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows).select("features")
    with lloyd.packed(vectors, "features") as held:
        for k, seed in ((2, 42), (5, 1), (9, -7)):
            library = KMeans(k=k, seed=seed, solver="row")
            first = library.fit(vectors, {library.maxIter: 0}).clusterCenters()
            assert np.allclose(lloyd.first_centers(held, k, seed, 2), first, rtol=0, atol=1e-12)
            expected, model = library.fit(vectors), clustering.fit_kmeans(vectors, k, seed)
            assert np.allclose(model.clusterCenters(), expected.clusterCenters(), rtol=0, atol=1e-9)
            assigned = model.transform(vectors)
            counts = [sorted(map(tuple, m.transform(vectors).groupBy("prediction").count().collect())) for m in (model, expected)]
            assert counts[0] == counts[1]
            score = clustering.silhouette_of(model, vectors, "silhouette", "squaredEuclidean")
            assert score == pytest.approx(clustering.silhouette(assigned), abs=1e-9)


def test_random_numbers_are_spark_s(spark):
    for seed in (0, 42, -7, 2**40 + 3):
        spark_s = spark.sparkContext._jvm.org.apache.spark.util.random.XORShiftRandom(seed)
        first, state = xorshift.doubles(xorshift.hashed(seed), 13)
        assert [*first, *xorshift.doubles(state, 20)[0]] == [spark_s.nextDouble() for _ in range(33)]


@pytest.mark.parametrize("values, clusters", [([3.0], 1), ([1.0, 2.0, 5.0], 3), ([-0.0, 0.0, 4.0], 2)])
def test_a_fit_of_fewer_values_than_clusters(spark, values, clusters):
    """A centre for each value; Spark's fit by blocks fails here."""
    rows = [(Vectors.dense([values[i % len(values)]]),) for i in range(60)]
    vectors = spark.createDataFrame(rows, ["features"]).repartition(4).persist()
    model = clustering.fit_kmeans(vectors, 4, 42)
    assert sorted(c[0] for c in model.clusterCenters()) == sorted({v + 0.0 for v in values})
    score = clustering.silhouette_of(model, vectors, "silhouette", "squaredEuclidean")
    assert math.isnan(score) if clusters == 1 else score == pytest.approx(1.0)
    vectors.unpersist()


def test_rows_of_a_training_are_packed_once(spark, products, monkeypatch):
    """Fits read plain numbers: the vectors are packed once for all k, and not stored as rows too."""
    packings, made, stored = [], lloyd.Packed.__init__, []
    monkeypatch.setattr(lloyd.Packed, "__init__", lambda self, *given: packings.append(1) or made(self, *given))
    sweep = clustering.sweep

    def watched(vectors, *given):
        found = sweep(vectors, *given)
        stored.append(spark.sparkContext._jsc.sc().getRDDStorageInfo())
        return found

    monkeypatch.setattr(training, "sweep", watched)
    spark.catalog.clearCache()
    train(products, PARAMS)
    assert len(packings) == 1
    assert not [info for info in stored[0] if info.numCachedPartitions()]
    assert not lloyd._SHARED


def test_blocks_do_not_depend_on_batches(spark):
    rows = spark.range(0, 50_000, 1, 3).selectExpr("array(id * 1.0D, id % 10 * 1.0D, 0.0D) AS z")
    vectors = rows.select(array_to_vector("z").alias("features"))

    def blocks():
        with lloyd.packed(vectors, "features") as held:
            return held.blocks.collect()

    one = blocks()
    assert len(one) == 3 and [(p, w) for p, w, _ in one] == [(0, 3), (1, 3), (2, 3)]
    with shared.settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "77"}):
        assert blocks() == one
