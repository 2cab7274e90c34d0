import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covey import Params, errors
from covey.functions.flatten import name_columns
from covey.operators import features, modes, preparation
from covey.operators.features import (
    align,
    column_profile,
    is_varying,
    numeric_columns,
    select_features,
)
from covey.sources import footers

ROWS = 100


def filled(spark, **columns):
    """A table of ROWS rows from SQL texts over ``id``."""
    return spark.range(ROWS).selectExpr(*[f"{text} AS {name}" for name, text in columns.items()])


def test_numeric_columns_by_type(spark):
    schema = T.StructType.fromDDL(
        "a double, b float, c int, d bigint, e smallint, f decimal(9,2), g tinyint, h boolean, "
        "i string, j struct<x:int>, k array<int>, l map<string,int>, m binary, n date"
    )
    assert numeric_columns(schema) == ["a", "b", "c", "d", "e", "f"]


def test_completeness_is_inclusive(spark):
    df = filled(
        spark,
        ninety="CASE WHEN id >= 10 THEN id END",
        eighty_nine="CASE WHEN id >= 11 THEN id END",
    )
    assert select_features(df, Params()) == (["ninety"], ROWS)


def test_constant_nan_and_infinite_columns_are_dropped(spark):
    df = filled(
        spark,
        good="CAST(id AS DOUBLE)",
        constant="CAST(1 AS INT)",
        nan="CASE WHEN id = 3 THEN CAST('NaN' AS DOUBLE) ELSE id END",
        inf="CASE WHEN id = 3 THEN CAST('Infinity' AS DOUBLE) ELSE id END",
        tiny="CAST(id % 3 AS TINYINT)",
    )
    assert select_features(df, Params())[0] == ["good"]


def test_nan_counts_as_present(spark):
    df = filled(spark, nan="CASE WHEN id = 3 THEN CAST('NaN' AS DOUBLE) ELSE id END")
    row = column_profile(df, ["nan"]).first()
    assert row.non_null == ROWS
    assert math.isnan(row.std)


def test_single_value_has_no_deviation(spark):
    profile = column_profile(spark.range(1).select(F.col("id").cast("double").alias("x")), ["x"])
    assert profile.first().std is None
    assert profile.select(is_varying()).first()[0] is False


def test_order_follows_the_schema(spark):
    df = filled(spark, z="id", a="id * 2", m="id * 3")
    assert select_features(df, Params())[0] == ["z", "a", "m"]


def test_names_with_dots_and_backticks(spark):
    df = spark.range(ROWS).select(F.col("id").alias("a.b"), F.col("id").alias("c`d"))
    assert select_features(df, Params())[0] == ["a.b", "c`d"]
    assert align(df, ["a.b", "c`d"], []).columns == ["a.b", "c`d"]


def test_one_shuffle_profiles_every_column(spark):
    profile = column_profile(filled(spark, a="id", b="id"), ["a", "b"])
    plan = profile._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "partial_stddev_samp" in plan


@pytest.mark.parametrize(
    "columns, rows, error",
    [
        ({"a": "id"}, 0, errors.EmptyInput),
        ({"a": "CAST(id AS STRING)"}, 0, errors.EmptyInput),
        ({"a": "CAST(id AS STRING)"}, 5, errors.NoNumericColumns),
        ({"a": "CASE WHEN id = 0 THEN id END"}, 5, errors.NoCompleteColumns),
        ({"a": "1"}, 5, errors.NoVaryingColumns),
        ({"a": "CAST('NaN' AS DOUBLE)"}, 5, errors.NoVaryingColumns),
    ],
)
def test_guards(spark, columns, rows, error):
    df = filled(spark, **columns).limit(rows)
    with pytest.raises(error) as caught:
        select_features(df, Params())
    assert isinstance(caught.value, ValueError)


def test_align_fills_drops_orders_and_casts(spark):
    df = spark.createDataFrame(
        [("x", 1, Decimal("2.50"), float("nan"), True)],
        "product_name string, a int, b decimal(9,2), c double, extra boolean",
    )
    out = align(df, ["c", "missing", "b", "a"], ["product_name_langs", "product_name"])
    assert out.columns == ["product_name_langs", "product_name", "c", "missing", "b", "a"]
    assert [t for _, t in out.dtypes] == ["string"] * 2 + ["double"] * 4
    assert tuple(out.first()) == (None, "x", None, None, 2.5, 1.0)
    kept = align(df, ["c"], [], nonfinite_as_null=False).first()
    assert math.isnan(kept.c)


def test_align_is_case_sensitive(spark):
    df = spark.createDataFrame([(1.0,)], "Level double")
    assert align(df, ["level"], []).first().level is None


ELEMENT = "array<struct<lang:string,text:string>>"


@pytest.mark.parametrize(
    "value, langs, texts",
    [
        (None, "", ""),
        ([], "", ""),
        ([("en", "x"), (None, "y"), ("fr", None)], "en | fr", "x | y"),
        ([("en", "tea"), ("fr", "thé")], "en | fr", "tea | thé"),
    ],
)
def test_flatten_array(spark, value, langs, texts):
    df = spark.createDataFrame([(value,)], f"product_name {ELEMENT}")
    out = df.select(*[c.alias(n) for n, c in name_columns(df.schema).items()]).first()
    assert out.asDict() == {"product_name_langs": langs, "product_name_texts": texts}


@pytest.mark.parametrize(
    "ddl, expected",
    [
        ("product_name array<struct<lang:string,other:int>>", ["product_name_langs"]),
        ("product_name array<struct<text:string>>", ["product_name_texts"]),
        ("product_name array<struct<other:int>>", []),
        ("product_name struct<a:int,b:string>", ["product_name_a", "product_name_b"]),
        ("product_name bigint", ["product_name"]),
        ("product_name array<string>", ["product_name"]),
        ("other string", []),
    ],
)
def test_flattened_names(spark, ddl, expected):
    assert list(name_columns(T.StructType.fromDDL(ddl))) == expected


def test_flatten_struct_and_scalar(spark):
    df = spark.createDataFrame([((1, "x"),)], "product_name struct<a:int,b:string>")
    out = df.select(*[c.alias(n) for n, c in name_columns(df.schema).items()])
    assert [t for _, t in out.dtypes] == ["string", "string"]
    assert tuple(out.first()) == ("1", "x")
    scalar = spark.createDataFrame([(7,)], "product_name int")
    assert scalar.select(*name_columns(scalar.schema).values()).first()[0] == "7"


def test_wide_tables_are_profiled_by_position(spark):
    """5,000 columns: nulls, NaN, infinities, constants, empty ones; numbers far from zero."""
    pick = np.random.default_rng(4)
    rows, width = 60, 5_000
    values = pick.normal(1e6, 1, (rows, width))
    values[:, 7] = 3.5
    values[5, 8], values[6, 9] = np.nan, np.inf
    missing = pick.random((rows, width)) < 0.2
    missing[:, 10] = True
    missing[:, 11] = np.arange(rows) > 0
    table = pa.table({f"c{i}": pa.array(values[:, i], mask=missing[:, i]) for i in range(width)})
    df = spark.createDataFrame(table).repartition(3)
    profile = {r.column_name: r for r in features.column_profile(df, df.columns).collect()}
    assert len(profile) == width and [profile[f"c{i}"].position for i in (0, 4_999)] == [0, 4_999]
    for i in range(0, width, 1 if width < 100 else 37):
        filled = values[~missing[:, i], i]
        got = profile[f"c{i}"]
        assert (got.n, got.non_null, got.ratio) == (rows, len(filled), len(filled) / rows)
        assert abs(got.std / filled.std(ddof=1) - 1) < 1e-9
    assert profile["c7"].std == 0
    assert math.isnan(profile["c8"].std) and math.isnan(profile["c9"].std)
    assert profile["c10"].std is None and profile["c10"].non_null == 0
    assert profile["c11"].std is None and profile["c11"].non_null == 1


def test_wide_and_narrow_profiles_agree(spark, monkeypatch):
    df = spark.range(0, 500, 1, 4).selectExpr(
        "id", "CAST(id % 7 AS SMALLINT) AS s", "IF(id % 3 = 0, NULL, CAST(id AS DECIMAL(9, 2)) / 3) AS `d.e`", "CAST(id AS FLOAT) AS f"
    )
    narrow = features.column_profile(df, df.columns).collect()
    monkeypatch.setattr(features, "_COLUMNS_AT_ONCE", 1)
    wide = sorted(features.column_profile(df, df.columns).collect())
    assert [tuple(r)[:5] for r in narrow] == [tuple(r)[:5] for r in wide]
    assert all(abs(a.std - b.std) < 1e-9 * a.std for a, b in zip(narrow, wide))
    empty = features.column_profile(df.limit(0), df.columns).collect()
    assert {(r.n, r.non_null, r.ratio, r.std) for r in empty} == {(0, 0, None, None)}


def test_counts_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(0, 1000, 1, 3).selectExpr(
        "id", "IF(id % 4 = 0, NULL, id) AS gaps", "IF(id < 10, 'x', NULL) AS text", "IF(id % 2 = 0, array(id), NULL) AS list", "id AS `a.b`"
    )
    df.write.parquet(path)
    found = footers.counts(spark, path, df.columns)
    assert found.rows == 1000
    assert found.non_null == {"id": 1000, "gaps": 750, "text": 10, "list": 500, "a.b": 1000}
    with footers.footers_only(spark, path) as read:
        plan = read.agg(F.count("*"), F.count("gaps"), F.count("text"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(gaps), COUNT(text)]" in plan
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_counts_beside_nested_columns(spark, tmp_path):
    """What nested columns consist of takes places in the footers; only columns before them count."""
    path = str(tmp_path / "t")
    df = spark.range(0, 300, 1, 3).selectExpr(
        "IF(id % 2 = 0, NULL, id) AS half",
        "named_struct('a', id, 'b', IF(id < 100, NULL, 'x')) AS pair",
        "IF(id % 3 = 0, NULL, id) AS thirds",
        "IF(id % 5 = 0, NULL, array(id, NULL)) AS list",
        "map('k', id, 'l', id) AS by_name",
        "IF(id < 10, id, NULL) AS few",
    )
    df.write.parquet(path)
    want = {"half": 150, "pair": 300, "thirds": 200, "list": 240, "by_name": 300, "few": 10}
    assert footers.counts(spark, path, df.columns) == footers.Counts(300, want)
    assert footers.counts(spark, path) == footers.Counts(300, {})
    assert footers.counts(spark, path, ["few"]) == footers.Counts(300, {"few": 10})
    assert features.select_stored_features(spark, path, Params(min_non_null_ratio=0.6)) == (["thirds"], 300)


def test_stored_features_are_the_same(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(200).selectExpr(
        "id", "CAST(id AS STRING) AS text", "IF(id % 10 = 0, NULL, id * 1.5D) AS kept", "IF(id % 9 = 0, NULL, id) AS dropped",
        "7 AS constant", "IF(id = 3, CAST('NaN' AS DOUBLE), id) AS nan", "CAST(id % 100 AS TINYINT) AS tiny",
    )
    df.write.parquet(path)
    got = features.select_stored_features(spark, path, Params())
    assert got == features.select_features(df, Params()) == (["id", "kept"], 200)
    for rows, error in ((df.limit(0), errors.EmptyInput), (df.select("text"), errors.NoNumericColumns), (df.select("dropped"), errors.NoCompleteColumns), (df.select("constant"), errors.NoVaryingColumns)):
        rows.write.mode("overwrite").parquet(path)
        with pytest.raises(error):
            features.select_stored_features(spark, path, Params())


@pytest.mark.parametrize("at_once", [16, 1])
def test_equal_numbers_have_no_deviation(spark, monkeypatch, at_once):
    """Means of parts are rounded, so deviations merged from them may come out just above 0."""
    monkeypatch.setattr(features, "_COLUMNS_AT_ONCE", at_once)
    df = spark.range(0, 997, 1, 13).selectExpr("7 AS a", "0.1D AS b", "1e300D AS c", "1D / 3 AS d")
    assert [r.std for r in features.column_profile(df, ["a", "b", "d"]).collect()] == [0.0] * 3
    with pytest.raises(errors.NoVaryingColumns):
        features.select_features(df, Params())


def test_modes_are_proved_or_counted(spark, monkeypatch):
    """Heavy values from the sketch; ties, near-unique and one-valued columns."""
    asked = []
    imputer = preparation.Imputer

    def watched(**kwargs):
        asked.append(kwargs.get("inputCols"))
        return imputer(**kwargs)

    monkeypatch.setattr(preparation, "Imputer", watched)
    df = spark.range(0, 6000, 1, 4).selectExpr(
        "IF(id % 3 = 0, 5.5D, id) AS heavy",
        "CAST(id % 20 AS DOUBLE) AS ties",
        "IF(id >= 5998, -4.0D, id + 0.5D) AS unique",
        "CASE WHEN id % 2 = 0 THEN CAST('NaN' AS DOUBLE) WHEN id % 5 = 0 THEN NULL WHEN id % 3 = 0 THEN -0.0D WHEN id % 7 = 0 THEN 0.0D ELSE id END AS odd",
        "2.0D AS same",
    )
    got = preparation.fit_imputer(df, df.columns, "mode").surrogateDF.first().asDict()
    want = imputer(strategy="mode", inputCols=df.columns, outputCols=[c + "_o" for c in df.columns]).fit(df).surrogateDF.first().asDict()
    assert {k: repr(v + 0.0) for k, v in got.items()} == {k: repr(v + 0.0) for k, v in want.items()}
    # The first call is for the columns without a heavy value; the other holds the known ones.
    assert asked[0] == ["ties", "unique"]
    assert modes.proven_modes(df, ["heavy", "same"]) == {"heavy": 5.5, "same": 2.0}
    assert modes.proven_modes(df.selectExpr("CAST(NULL AS DOUBLE) AS empty"), ["empty"]) == {}
