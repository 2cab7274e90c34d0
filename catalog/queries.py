"""Spark side of the registered queries: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import nearest
from catalog.inputs import (
    FLAG_FEATURES,
    FLAGS,
    GAPS,
    LINE_FEATURES,
    TABLES,
    derived,
    table,
)
from covey.functions.documents import as_documents
from covey.functions.keys import ContentKey
from covey import errors
from covey.operators import clustering, features, lloyd, medians, preparation, profiles, sampling, words
from covey.params import Params
from covey.plans.scoring import run_scoring, score
from covey.plans.training import TrainingOutputs, run_training, train
from covey.sinks.collections import IMPORTS, METRICS, CollectionStore, stamped
from covey.sinks.files import write_csv_parts
from covey.sinks.models import load_model, save_model
from covey.sources import documents, footers, tables
from covey.sources.layout import StoredRows, store_distinct
from covey.sources.shared import fresh_path, materialise

CENTERS = [(10.0, 0.02), (25.0, 0.05), (40.0, 0.08)]
CENTER_FEATURES = ["l_quantity", "l_discount"]
SCALED_CENTERS = [(-1.0, -0.5, 0.25, 0.0), (1.0, 0.5, -0.25, 2.0)]
EXACT = Params(k_max=4, relative_error=0.0)


# --- scans, sinks, collections -------------------------------------------------------------


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"
    )


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the footers of the files."""
    counts = [(t, footers.counts(spark, f"{sf_dir}/{t}.parquet").rows) for t in TABLES]
    return spark.createDataFrame(counts, "table_name string, n long")


def text_scan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "lines")
    table(spark, sf_dir, "documents").select("text").write.text(path)
    return tables.read_text_lines(spark, path).groupBy("value").agg(F.count("*").alias("n"))


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "json")
    orders = table(spark, sf_dir, "orders")
    orders.write.json(path)
    return tables.read_json_lines(spark, path, orders.schema)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with an empty and a missing segment, both of which survive."""
    path = fresh_path(spark, "csv")
    customers = table(spark, sf_dir, "customer").withColumn(
        "c_mktsegment",
        F.when(F.col("c_mktsegment") == "BUILDING", "").when(
            F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")
        ),
    )
    write_csv_parts(customers, path, empty_as="<empty>")
    return tables.read_csv(spark, path, customers.schema, empty_as="<empty>")


def _store(spark: SparkSession) -> CollectionStore:
    return CollectionStore(spark, fresh_path(spark, "store"))


def collection_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark)
    store.replace("stock", table(spark, sf_dir, "supplier"))
    rows = store.replace("stock", table(spark, sf_dir, "part"))
    return store.read("stock").withColumn("stored_rows", F.lit(rows).cast("long"))


def collection_read_projected(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark)
    store.replace("stock", table(spark, sf_dir, "part"))
    return store.read("stock", ["p_partkey", "p_retailprice"], optional=["p_name", "product_name"])


def _external_store(spark: SparkSession) -> CollectionStore:
    """A store that is reached by the data source's protocol only."""
    documents.register(spark)
    options = {"client": "covey.sinks.folder_store:FolderStore", "uri": fresh_path(spark, "external")}
    return CollectionStore(spark, None, documents.FORMAT, options)


def external_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _external_store(spark)
    store.replace("stock", table(spark, sf_dir, "supplier"))
    rows = store.replace("stock", table(spark, sf_dir, "part"))
    return store.read("stock").withColumn("stored_rows", F.lit(rows).cast("long"))


def external_read_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chosen columns and conditions: by number, text and null; one that Spark judges itself."""
    store = _external_store(spark)
    store.replace("lines", table(spark, sf_dir, "lineitem"))
    chosen = store.read("lines", ["l_orderkey", "l_linenumber", "l_returnflag", "l_tax"], optional=["none"])
    return chosen.filter("l_linenumber >= 3 AND l_returnflag IN ('A', 'N') AND l_tax > 0.02 AND l_orderkey IS NOT NULL")


def collection_of_differing_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of different fields appended to one collection: each row has null in the others' fields."""
    store = _store(spark)
    store.append("parties", table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_mktsegment"))
    store.append("parties", table(spark, sf_dir, "supplier").selectExpr("s_acctbal", "s_name AS name", "s_suppkey AS id"))
    store.append("parties", table(spark, sf_dir, "nation").selectExpr("n_nationkey AS id", "n_name AS name"))
    return store.read("parties")


def append_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark)
    for name in ("part", "supplier", "customer"):
        store.import_table(name, table(spark, sf_dir, name), f"{sf_dir}/{name}.parquet")
    return store.read(IMPORTS, ["collection", "rows"])


def normalise_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    discount = (
        "CASE WHEN l_discount = 0 THEN CAST('NaN' AS DOUBLE) "
        "WHEN l_discount = 0.1 THEN CAST('Infinity' AS DOUBLE) ELSE l_discount END"
    )
    raw = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        f"{discount} AS discount",
        "CAST(l_extendedprice AS DECIMAL(15, 2)) AS price",
        "l_shipdate AS shipped",
        "CAST(l_shipdate AS DATE) AS ship_day",
        f"named_struct('rate', {discount}, 'at', l_shipdate) AS nested",
        f"array({discount}, l_tax) AS rates",
        f"map('discount', {discount}) AS by_name",
    )
    return as_documents(raw).select(
        "l_orderkey",
        "l_linenumber",
        "discount",
        "price",
        "shipped",
        "ship_day",
        F.col("nested.rate").alias("nested_rate"),
        F.col("nested.at").alias("nested_at"),
        F.col("rates")[0].alias("rate_0"),
        F.col("rates")[1].alias("rate_1"),
        F.col("by_name")["discount"].alias("by_name_discount"),
    )


def normalise_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").selectExpr(
        "event_id", "ts", "CAST(value AS FLOAT) AS value", "CAST(props AS BINARY) AS props"
    )
    return as_documents(raw)


# --- columns -------------------------------------------------------------------------------


def numeric_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numeric columns of every table, with the values they hold."""
    found = []
    for name in TABLES:
        df = table(spark, sf_dir, name)
        columns = features.numeric_columns(df.schema)
        found.append(
            features.column_profile(df, columns).select(
                F.lit(name).alias("table_name"), "column_name", "non_null"
            )
        )
    return reduce(DataFrame.union, found)


def feature_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = table(spark, sf_dir, "documents").join(
        table(spark, sf_dir, "labels"), "doc_id", "left"
    )
    return _completeness(labelled)


def completeness_from_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every column of lines with gaps, texts included."""
    path = fresh_path(spark, "gaps")
    derived(table(spark, sf_dir, "lineitem"), GAPS | {"flag": "nullif(l_returnflag, 'A')"}).write.parquet(path)
    columns = spark.read.parquet(path).columns
    found = footers.counts(spark, path, columns)
    return spark.createDataFrame(
        [(c, found.rows, found.non_null[c], found.non_null[c] / found.rows) for c in columns],
        "column_name string, n long, non_null long, ratio double",
    )


def wide_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """400 columns made of four, profiled by position."""
    gaps = derived(table(spark, sf_dir, "lineitem"), GAPS)
    names = ["quantity", "price", "discount", "fixed"]
    wide = gaps.select(*[(F.col(c) + F.lit(i)).alias(f"{c}_{i}") for i in range(100) for c in names])
    return features.column_profile(wide, wide.columns).select(
        "column_name", "n", "non_null", "ratio", F.round("std", 6).alias("std")
    )


def feature_completeness_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _completeness(derived(table(spark, sf_dir, "lineitem"), GAPS))


def _completeness(df: DataFrame) -> DataFrame:
    return features.column_profile(df, features.numeric_columns(df.schema)).select(
        "column_name",
        "n",
        "non_null",
        "ratio",
        features.is_complete(Params().min_non_null_ratio).alias("kept"),
    )


def feature_stddev(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = derived(table(spark, sf_dir, "lineitem"), GAPS)
    return features.column_profile(gaps, ["quantity", "price", "discount", "fixed"]).select(
        "column_name", F.round("std", 6).alias("std")
    )


def feature_variance_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = derived(table(spark, sf_dir, "lineitem"), GAPS)
    return features.column_profile(gaps, features.numeric_columns(gaps.schema)).select(
        "column_name", features.is_varying().alias("kept")
    )


def feature_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type, completeness and variance together."""
    gaps = derived(table(spark, sf_dir, "lineitem"), GAPS)
    return (
        features.column_profile(gaps, features.numeric_columns(gaps.schema))
        .where(features.is_complete(Params().min_non_null_ratio) & features.is_varying())
        .select("column_name", F.col("position").cast("int").alias("position"))
    )


def cast_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_size", "CAST(p_retailprice AS DECIMAL(12, 2)) AS p_retailprice"
    )
    return features.cast_features(part, features.numeric_columns(part.schema))


def align_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").withColumnRenamed("p_name", "product_name")
    return features.align(
        part, ["p_retailprice", "weight", "p_partkey"], ["product_name", "product_name_langs"]
    )


def flatten_array_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        "CASE WHEN lang = 'de' THEN filter(array(named_struct('lang', lang, 'text', text)), e -> false)"
        " WHEN lang <> 'es' THEN array(named_struct('lang', lang, 'text', text),"
        " named_struct('lang', CAST(NULL AS STRING), 'text', source),"
        " named_struct('lang', source, 'text', CAST(NULL AS STRING))) END AS product_name",
    )
    return _flattened(documents)


def flatten_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flattened(
        table(spark, sf_dir, "documents").select(
            "doc_id", F.struct("lang", "source", "n_chars").alias("product_name")
        )
    )


def flatten_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flattened(
        table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").alias("product_name"))
    )


def _flattened(df: DataFrame) -> DataFrame:
    names = features.name_columns(df.schema)
    return df.select("doc_id", *[c.alias(name) for name, c in names.items()])


# --- rows ----------------------------------------------------------------------------------


def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.distinct_rows(
        table(spark, sf_dir, "lineitem").select(
            "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"
        )
    )


def capped_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.capped_sample(table(spark, sf_dir, "lineitem"), 1_000, seed=42, method="md5")


def capped_sample_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_quantity", "l_discount", "l_returnflag")
    return sampling.capped_sample(rows, 500, seed=42, distinct=True, method="md5")


def capped_sample_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From rows that repeat often, copies included."""
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    return sampling.capped_sample(rows, 5_000, seed=42, method="md5")


def capped_sample_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default sample against a full ordering by its key, with copies and without."""
    rows = table(spark, sf_dir, "lineitem").select("l_quantity", "l_discount", "l_linenumber")
    key = ContentKey(rows.schema, 42)
    found = []
    for distinct, n in ((False, 5_000), (True, 700)):
        sample = sampling.capped_sample(rows, n, seed=42, distinct=distinct)
        ordered = (rows.distinct() if distinct else rows).orderBy(key.text()).limit(n)
        wrong = sample.exceptAll(ordered).unionAll(ordered.exceptAll(sample))
        found.append(
            sample.agg(F.lit(distinct).alias("distinct_rows"), F.count("*").alias("n")).join(
                wrong.agg(F.count("*").alias("mismatches"))
            )
        )
    return found[0].union(found[1])


# --- preparation ---------------------------------------------------------------------------


def medians_by_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default surrogates: is each within a thousandth of the middle rank?"""
    gaps = derived(table(spark, sf_dir, "lineitem"), GAPS)
    columns = ["quantity", "price", "tax", "discount"]
    found = preparation.fit_imputer(gaps, columns).surrogateDF.first().asDict()
    ranks = []
    for c in columns:
        valid = F.when(~F.isnan(c), F.col(c))
        below, up_to, n = F.count_if(valid < found[c]), F.count_if(valid <= found[c]), F.count(valid)
        slack = n * Params().relative_error + 1
        ranks.append(F.struct(F.lit(c).alias("column_name"), ((below - slack <= n / 2) & (up_to + slack >= n / 2)).alias("within")))
    return gaps.agg(F.array(*ranks).alias("ranks")).select(F.inline("ranks"))


def align_text_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features that a table holds as texts, some of which spell what is no finite number."""
    texts = derived(
        table(spark, sf_dir, "lineitem"),
        {
            "l_orderkey": "l_orderkey",
            "size": "CASE l_returnflag WHEN 'A' THEN 'Infinity' WHEN 'N' THEN 'NaN' ELSE CAST(l_linenumber AS STRING) END",
        },
    )
    return features.align(texts, ["size", "l_orderkey", "absent"], ["product_name"])


def impute_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = derived(table(spark, sf_dir, "lineitem"), GAPS)
    columns = ["quantity", "price", "tax"]
    found = []
    for strategy in ("median", "mean", "mode"):
        model = preparation.fit_imputer(gaps, columns, strategy, relative_error=0.0)
        rows = [
            F.struct(
                F.lit(strategy).alias("strategy"),
                F.lit(c).alias("column_name"),
                F.round(c, 6).alias("surrogate"),
            )
            for c in columns
        ]
        found.append(model.surrogateDF.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.union, found)


def impute_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = derived(table(spark, sf_dir, "lineitem"), GAPS)
    columns = ["quantity", "price", "tax"]
    model = preparation.fit_imputer(gaps, columns, relative_error=0.0)
    return model.transform(gaps).select(
        "l_orderkey", "l_linenumber", *preparation.imputed(columns)
    )


def _complete_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, preparation.Preparation]:
    lines = table(spark, sf_dir, "lineitem").select(*LINE_FEATURES)
    return lines, preparation.fit_preparation(lines, LINE_FEATURES, "mean")


def scaler_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, fitted = _complete_lines(spark, sf_dir)
    # One row per feature.
    stats = zip(LINE_FEATURES, fitted.scaler.mean.toArray(), fitted.scaler.std.toArray())
    return spark.createDataFrame(
        [(c, float(mean), float(std)) for c, mean, std in stats],
        "column_name string, mean double, std double",
    ).select("column_name", F.round("mean", 7).alias("mean"), F.round("std", 7).alias("std"))


def assemble_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, fitted = _complete_lines(spark, sf_dir)
    vector = vector_to_array(preparation.RAW_VECTOR)
    assembled = preparation.assemble(fitted.imputer.transform(lines), LINE_FEATURES)
    return assembled.select(*[vector[i].alias(f"x{i}") for i in range(len(LINE_FEATURES))])


def standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, fitted = _complete_lines(spark, sf_dir)
    vector = vector_to_array(preparation.VECTOR)
    return fitted.transform(lines).select(
        *[F.round(vector[i], 6).alias(f"z{i}") for i in range(len(LINE_FEATURES))]
    )


# --- clustering ----------------------------------------------------------------------------


def assign_fixed_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *CENTER_FEATURES)
    return nearest.assign_to_centers(lines, CENTER_FEATURES, CENTERS)


def cluster_centers_original_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, fitted = _complete_lines(spark, sf_dir)
    centers = clustering.centers_in_original_units(
        spark, SCALED_CENTERS, fitted.scaler, LINE_FEATURES
    )
    return centers.select("prediction", *[F.round(c, 7).alias(c) for c in LINE_FEATURES])


def _labelled(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").selectExpr(*LINE_FEATURES, f"{label} AS prediction")
    return VectorAssembler(inputCols=LINE_FEATURES, outputCol="features").transform(lines)


FLAG_LABEL = "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END"
STATUS_LABEL = "CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END"


def _score_row(spark: SparkSession, score_value: float) -> DataFrame:
    return spark.createDataFrame([(round(score_value, 6),)], "score double")


def silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _score_row(spark, clustering.silhouette(_labelled(spark, sf_dir, FLAG_LABEL)))


def silhouette_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = _labelled(spark, sf_dir, FLAG_LABEL)
    return _score_row(spark, clustering.silhouette(labelled, distance_measure="cosine"))


def best_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best of three ways the table itself groups its lines."""
    scores = [
        (k, clustering.silhouette(_labelled(spark, sf_dir, label)))
        for k, label in ((2, STATUS_LABEL), (3, FLAG_LABEL), (7, "l_linenumber - 1"))
    ]
    best = clustering.best_of(spark.createDataFrame(scores, "k int, score double"))
    return best.select("k", F.round("score", 6).alias("score"))


def best_k_tie_and_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same choice among more: every grouping again under a larger k, and one without a score."""
    scores = [
        (again + k, clustering.silhouette(_labelled(spark, sf_dir, label)))
        for k, label in ((2, STATUS_LABEL), (3, FLAG_LABEL), (7, "l_linenumber - 1"))
        for again in (10, 0)
    ]
    scores.append((1, clustering.silhouette(_labelled(spark, sf_dir, "l_linenumber * 0"))))
    best = clustering.best_of(spark.createDataFrame(scores, "k int, score double"))
    return best.select("k", F.round("score", 6).alias("score"))


def cluster_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = derived(table(spark, sf_dir, "lineitem"), GAPS | {"l_quantity": "l_quantity"})
    assigned = nearest.assign_to_centers(gaps, ["l_quantity", "discount"], CENTERS)
    return profiles.cluster_profiles(assigned, ["quantity", "price", "discount"])


def prediction_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = assign_fixed_centers(spark, sf_dir)
    summary = profiles.prediction_summary(
        profiles.prediction_counts(assigned), "run", "model", "in", "out"
    )
    return summary.select("rows", F.inline("clusters"))


def _flag_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(table(spark, sf_dir, "lineitem"), FLAGS)


def _fitted(
    rows: DataFrame, columns: list[str], k: int
) -> tuple[DataFrame, preparation.Preparation, KMeansModel]:
    """The distinct rows prepared, and a model of ``k`` clusters over all of them."""
    stored = _stored(rows)
    fitted, vectors = clustering.training_vectors(stored, columns, "mean", 0.001)
    model = clustering.fit_kmeans(vectors, k, seed=42)
    vectors.unpersist()
    return fitted.transform(stored.rows()), fitted, model


def _stored(rows: DataFrame) -> StoredRows:
    return store_distinct(rows, clustering.canonical_partitions(rows.count(), len(rows.columns)))


def kmeans_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and centres where the clusters are known."""
    rows = features.align(_flag_lines(spark, sf_dir), FLAG_FEATURES, [])
    prepared, fitted, model = _fitted(rows, FLAG_FEATURES, 3)
    sizes = model.transform(prepared).groupBy("prediction").agg(F.count("*").alias("n"))
    centers = clustering.centers_in_original_units(
        spark, model.clusterCenters(), fitted.scaler, FLAG_FEATURES
    )
    return centers.join(sizes, "prediction").select(
        "n", *[F.round(c, 6).alias(c) for c in FLAG_FEATURES]
    )


def _nearest_check(rows: DataFrame, columns: list[str], k: int) -> DataFrame:
    """Fit, then compare the model's clusters with the nearest of its centres."""
    prepared, _, model = _fitted(rows, columns, k)
    vector = vector_to_array(preparation.VECTOR)
    slots = [f"z{i}" for i in range(len(columns))]
    assigned = model.transform(prepared).select(
        "prediction", *[vector[i].alias(slot) for i, slot in enumerate(slots)]
    )
    closest = nearest.nearest_center(slots, [list(c) for c in model.clusterCenters()])
    return assigned.agg(
        F.count("*").alias("n"),
        F.count_if(closest != F.col("prediction")).alias("mismatches"),
        F.count_distinct("prediction").alias("clusters"),
    )


def kmeans_fit_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(*LINE_FEATURES)
    return _nearest_check(rows, LINE_FEATURES, 3)


def kmeans_fit_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every component of the vectors is a column; vectors of another width are an error."""
    vectors = table(spark, sf_dir, "embeddings")
    width = vectors.agg(F.max(F.size("embedding"))).first()[0]
    same = F.assert_true(F.size("embedding") == width, "vectors differ in width")
    rows = vectors.select(
        *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(width)], same.alias("same")
    ).filter("same IS NULL").drop("same")
    return _nearest_check(rows, rows.columns, 10)


# --- jobs ----------------------------------------------------------------------------------


def k_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The winner of a sweep where the right k is known."""
    scores = train(_flag_lines(spark, sf_dir), EXACT).scores
    return clustering.best_of(scores).select("k", F.round("score", 6).alias("score"))


def k_sweep_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over natural rows: does each k's score equal the closed form from the clusters' sums?"""
    stored = _stored(table(spark, sf_dir, "lineitem").select(*LINE_FEATURES))
    n = stored.rows().count()
    prepared, vectors = clustering.training_vectors(stored, LINE_FEATURES, "median", 0.0)
    checked = []
    # One packing of the vectors for all fits.
    with lloyd.packed(vectors, preparation.VECTOR):
        swept = clustering.sweep(vectors, n, len(LINE_FEATURES), Params(k_max=4))
        for k, found in swept.scores.collect():
            assigned = clustering.fit_kmeans(vectors, k, Params().seed).transform(vectors)
            equal = abs(found - _silhouette_from_sums(assigned, len(LINE_FEATURES))) < 1e-9
            # Jobs of its own: some, and none that another k has too.
            others = {job for other, ids in swept.jobs.items() if other != k for job in ids}
            checked.append((k, equal, bool(swept.jobs[k]) and others.isdisjoint(swept.jobs[k]), n))
    vectors.unpersist()
    return spark.createDataFrame(checked, "k int, equal boolean, own_jobs boolean, n long")


def _silhouette_from_sums(assigned: DataFrame, width: int) -> float:
    """Mean silhouette of squared distances, with each row's distances to a whole cluster taken
    from the cluster's count, sum and sum of squares (at most k rows)."""
    z = vector_to_array(preparation.VECTOR)
    rows = assigned.select("prediction", *[z[i].alias(f"z{i}") for i in range(width)])
    names = [F.col(f"z{i}") for i in range(width)]
    square = reduce(lambda x, y: x + y, [c * c for c in names])
    sums = rows.groupBy("prediction").agg(
        F.count("*").alias("n"), F.sum(square).alias("squares"), *[F.sum(c) for c in names]
    )
    own, others = F.lit(None).cast("double"), []
    for label, n, squares, *total in sums.collect():
        dot = reduce(lambda x, y: x + y, [c * F.lit(t) for c, t in zip(names, total)])
        away = square * n + F.lit(squares) - dot * 2
        mine = F.col("prediction") == label
        own = F.when(mine, away / max(n - 1, 1)).otherwise(own)
        others.append(F.when(~mine, away / n))
    nearest_other = F.least(*others)
    return rows.agg(F.avg((nearest_other - own) / F.greatest(nearest_other, own))).first()[0]


def train_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train(_flag_lines(spark, sf_dir), EXACT).profiles.drop("prediction")


def train_profiles_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over natural rows: the clusters' rows, and the features' sums from the clusters' means.
    Sums, as the values have two decimals at most: means over all rows may be ties of rounding."""
    result = train(table(spark, sf_dir, "lineitem"), Params(k_max=4))
    names = result.model.feature_cols
    unrounded = profiles.cluster_profiles(result.assignments, names, 12)
    return unrounded.agg(
        F.sum("n").alias("n"),
        *[F.round(F.sum(F.col(c) * F.col("n")), 2).alias(c) for c in names],
    )


def train_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profiles of a training on lineitem, as the job reports them."""
    return train(table(spark, sf_dir, "lineitem"), Params(k_max=4)).profiles


def train_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    centers = train(_flag_lines(spark, sf_dir), EXACT).centers
    return centers.select(*[F.round(c, 6).alias(c) for c in FLAG_FEATURES])


def train_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every working row, with the size of the cluster it fell into."""
    assigned = train(_flag_lines(spark, sf_dir), EXACT).assignments
    sizes = assigned.groupBy("prediction").agg(F.count("*").alias("cluster_rows"))
    # At most k rows.
    return assigned.join(F.broadcast(sizes), "prediction").drop("prediction")


def metrics_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark)
    metrics = train(_flag_lines(spark, sf_dir), EXACT).metrics
    store.replace(METRICS, stamped(metrics, "run"))
    return store.read(METRICS).select(
        "run_id",
        "best_k",
        F.round("best_score", 6).alias("best_score"),
        "metric_name",
        "rows_total",
        "rows_working",
        "features_count",
        F.concat_ws(",", "features").alias("features"),
    )


def model_roundtrip_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved and loaded model against the one in memory, row by row."""
    lines = _flag_lines(spark, sf_dir)
    model = train(lines, EXACT).model
    root = fresh_path(spark, "model")
    save_model(spark, model, root)
    loaded = load_model(spark, root)
    rows = sampling.distinct_rows(features.align(lines, model.feature_cols, model.product_cols))
    before = model.kmeans.transform(model.preparation.transform(rows))
    after = loaded.kmeans.setPredictionCol("reloaded").transform(
        loaded.preparation.transform(before.select(*rows.columns, "prediction"))
    )
    return after.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("prediction") != F.col("reloaded")).alias("mismatches"),
        F.count_distinct("reloaded").alias("clusters"),
        F.lit(",".join(loaded.feature_cols)).alias("features"),
        F.lit(",".join(loaded.product_cols)).alias("products"),
    )


def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct rows per flag, and over how many clusters each flag was spread."""
    lines = _flag_lines(spark, sf_dir)
    root = fresh_path(spark, "model")
    save_model(spark, train(lines, EXACT).model, root)
    scored = score(lines, load_model(spark, root))
    return scored.groupBy("product_name").agg(
        F.count("*").alias("n"), F.count_distinct("prediction").alias("clusters")
    )


def score_batch_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model of four features over whole rows, copies kept: is each in its nearest cluster?"""
    lines = table(spark, sf_dir, "lineitem")
    model = train(lines.select(*LINE_FEATURES), Params(k_max=3)).model
    scored = score(lines, model, deduplicate=False)
    prepared = model.preparation.transform(scored)
    z = vector_to_array(preparation.VECTOR)
    slots = [f"z{i}" for i in range(len(LINE_FEATURES))]
    placed = prepared.select("prediction", *[z[i].alias(slot) for i, slot in enumerate(slots)])
    closest = nearest.nearest_center(slots, [list(c) for c in model.kmeans.clusterCenters()])
    return placed.agg(
        F.count("*").alias("n"), F.count_if(closest != F.col("prediction")).alias("mismatches")
    )


def train_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files of a training run, read back: rows in each, and the rows that they tell of."""
    root = fresh_path(spark, "files")
    _flag_lines(spark, sf_dir).write.parquet(f"{root}/lines")
    outputs = TrainingOutputs(
        f"{root}/model", f"{root}/clusters.csv", f"{root}/profiles.csv", f"{root}/centers.csv",
        f"{root}/metrics.json", clusters_single_file=True,
    )
    run_training(spark, f"{root}/lines", outputs, EXACT)

    def csv(name: str, told: Column) -> DataFrame:
        rows = spark.read.csv(f"{root}/{name}.csv", header=True, inferSchema=True)
        return rows.agg(F.lit(name).alias("file"), F.count("*").alias("rows"), told.cast("long").alias("told"))

    metrics = spark.read.option("multiLine", True).json(f"{root}/metrics.json")
    return (
        csv("clusters", F.count("*"))
        .unionByName(csv("profiles", F.sum("n")))
        .unionByName(csv("centers", F.max("prediction") + 1))
        .unionByName(metrics.agg(F.lit("metrics").alias("file"), F.count("*").alias("rows"), F.sum("rows_working").alias("told")))
    )


def guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every guard against the input it is there for, derived from lineitem."""
    lines = table(spark, sf_dir, "lineitem")
    store = _store(spark)
    store.replace("empty", lines.where("l_quantity < 0"))
    cases = {
        errors.EmptyInput: lambda: features.select_features(lines.where("l_quantity < 0"), Params()),
        errors.NoNumericColumns: lambda: features.select_features(lines.select("l_returnflag"), Params()),
        errors.NoCompleteColumns: lambda: features.select_features(
            lines.selectExpr("CASE WHEN l_linenumber = 1 THEN l_quantity END AS q"), Params()
        ),
        errors.NoVaryingColumns: lambda: features.select_features(lines.selectExpr("1.0D AS one"), Params()),
        errors.TooFewRows: lambda: train(lines.selectExpr("CAST(l_linenumber % 2 AS DOUBLE) AS odd")),
        errors.TooFewRowsForSweep: lambda: clustering.sweep(
            lines, lines.select("l_linestatus").distinct().count(), 1, Params()
        ),
        errors.ReservedNames: lambda: train(lines.withColumnRenamed("l_quantity", "prediction")),
        errors.EmptyCollection: lambda: store.read("empty"),
    }
    rows = []
    for expected, run in cases.items():
        try:
            run()
            raised = ""
        except errors.GuardError as error:
            raised = type(error).__name__
        rows.append((expected.__name__, raised))
    return spark.createDataFrame(rows, "guard string, raised string")


def medians_of_heavy_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact medians of columns with few values, each in many rows."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.explode(F.sequence(F.lit(1), F.lit(40))).alias("copy"),
        F.col("l_quantity").cast("double").alias("quantity"),
        (F.col("l_linenumber") % 2).cast("double").alias("odd"),
    ).withColumn("flag", (F.col("copy") % 2).cast("double"))
    found = medians.exact_lower_medians(lines, ["quantity", "odd", "flag"])
    return spark.createDataFrame([tuple(found.values())], "quantity double, odd double, flag double")


def score_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job, from files to files: train, save, score, write, summarise."""
    root = fresh_path(spark, "job")
    lines_path = f"{root}/lines"
    _flag_lines(spark, sf_dir).write.parquet(lines_path)
    store = CollectionStore(spark, f"{root}/store")
    run_training(
        spark, lines_path, TrainingOutputs(model_root=f"{root}/model"), EXACT, store
    )
    run_scoring(spark, f"{root}/model", lines_path, f"{root}/scored", store)
    written = tables.read_csv(
        spark,
        f"{root}/scored",
        T.StructType.fromDDL(
            "product_name string, level double, load double, spread double, prediction int"
        ),
    )
    counted = store.read("prediction_summary").select("rows", F.inline("clusters"))
    found = written.groupBy("prediction").agg(
        F.min("product_name").alias("product_name"), F.count("*").alias("n")
    )
    return counted.join(found, "prediction").select("product_name", "rows", "count", "n")


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_count(table(spark, sf_dir, "documents"), "text")


def word_count_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from text files, line by line."""
    path = fresh_path(spark, "words")
    table(spark, sf_dir, "conversations").select("text").write.text(path)
    return words.word_count(tables.read_text_lines(spark, path))


QUERIES = [
    scan_parquet,
    row_count,
    text_scan_lines,
    json_roundtrip,
    csv_roundtrip,
    collection_replace,
    collection_read_projected,
    external_replace,
    external_read_filtered,
    collection_of_differing_fields,
    append_audit,
    normalise_documents,
    normalise_events,
    numeric_columns,
    feature_completeness,
    completeness_from_footers,
    wide_profile,
    feature_completeness_gaps,
    feature_stddev,
    feature_variance_filter,
    feature_selection,
    cast_features,
    align_schema,
    flatten_array_struct,
    flatten_struct,
    flatten_scalar,
    distinct_rows,
    capped_sample,
    capped_sample_distinct,
    capped_sample_copies,
    capped_sample_default,
    medians_by_sketch,
    align_text_numbers,
    impute_surrogates,
    impute_values,
    scaler_stats,
    assemble_vector,
    standardise,
    assign_fixed_centers,
    cluster_centers_original_units,
    silhouette,
    silhouette_cosine,
    best_k,
    best_k_tie_and_nan,
    cluster_profiles,
    prediction_summary,
    kmeans_fit,
    kmeans_fit_lineitem,
    kmeans_fit_embeddings,
    k_sweep,
    k_sweep_lineitem,
    train_profiles,
    train_profiles_lineitem,
    train_report,
    train_files,
    guards,
    medians_of_heavy_values,
    train_centers,
    train_assignments,
    metrics_document,
    model_roundtrip_scores,
    score_batch,
    score_batch_lineitem,
    score_job,
    word_count,
    word_count_lines,
]
