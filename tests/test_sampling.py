"""Samples and medians against brute force on small fixtures."""

import math
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from covey.functions.keys import ContentKey
from covey.operators import medians, sampling

NAN = float("nan")


def brute_force(df, n, seed, method, distinct):
    """All rows on the driver, ordered by key; copies stay together."""
    if distinct:
        df = df.dropDuplicates()
    keyed = df.withColumn("k", ContentKey(df.schema, seed, method).text()).collect()
    return Counter(tuple(r)[:-1] for r in sorted(keyed, key=lambda r: r.k)[:n])


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows are one row, another third few rows, the rest distinct."""
    return spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 WHEN id % 3 = 1 THEN id % 5 ELSE id END AS a",
        "CASE WHEN id % 3 = 2 THEN CAST(id AS STRING) END AS b",
        "CASE WHEN id % 3 = 0 THEN -0.0D ELSE 0.0D END AS c",
    ).repartition(5)


@pytest.mark.parametrize("method", ["xxhash64", "md5"])
@pytest.mark.parametrize("distinct", [False, True])
@pytest.mark.parametrize("n", [1, 10, 500, 999, 2000, 2999])
def test_sample_is_exact(hot, method, distinct, n):
    got = sampling.capped_sample(hot, n, 7, distinct=distinct, method=method)
    rows = Counter(tuple(r) for r in got.collect())
    expected = brute_force(hot, n, 7, method, distinct)
    assert got.columns == ["a", "b", "c"]
    assert rows == expected


def test_sample_ignores_layout(hot):
    one = sampling.capped_sample(hot.coalesce(1), 100, 42)
    many = sampling.capped_sample(hot.repartition(13), 100, 42)
    assert Counter(one.collect()) == Counter(many.collect())


def test_seed_changes_the_sample(hot):
    one = sampling.capped_sample(hot, 100, 1, distinct=True).collect()
    two = sampling.capped_sample(hot, 100, 2, distinct=True).collect()
    assert set(one) != set(two)


def test_small_input_is_kept_whole(hot):
    assert sampling.capped_sample(hot, 3000, 1).count() == 3000
    distinct = sampling.capped_sample(hot, 3000, 1, distinct=True)
    assert distinct.count() == hot.dropDuplicates().count()


def test_narrowing_goes_on_past_one_round(hot, monkeypatch):
    monkeypatch.setattr(sampling, "_PREFIX_DIGITS", 1)
    monkeypatch.setattr(sampling, "_RANKED_IN_ONE_TASK", 2)
    monkeypatch.setattr(sampling, "_EXPLODED_AT_ONCE", 3)
    for n in (37, 1500):
        got = sampling.capped_sample(hot, n, 3)
        assert Counter(tuple(r) for r in got.collect()) == brute_force(hot, n, 3, "xxhash64", False)


def test_bernoulli_never_returns_more(hot):
    got = sampling.capped_sample(hot, 200, 42, method="bernoulli").count()
    assert 0 < got <= 200


def test_unknown_method(hot):
    with pytest.raises(ValueError):
        sampling.capped_sample(hot, 1, 1, method="other")


def test_nulls_in_different_columns_have_different_keys(spark):
    df = spark.createDataFrame([("x", None), (None, "x"), ("", "x"), ("x", "")], "a string, b string")
    for method in ("xxhash64", "md5"):
        keys = df.select(ContentKey(df.schema, 1, method).text()).collect()
        assert len(set(keys)) == 4


def test_distinct_rows(spark):
    df = spark.createDataFrame([(NAN,), (NAN,), (None,), (None,), (0.0,), (-0.0,)], "x double")
    assert sampling.distinct_rows(df).count() == 3


def lower_median(values):
    valid = sorted(v for v in values if v is not None and not math.isnan(v))
    return valid[(len(valid) + 1) // 2 - 1] if valid else None


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.one_of(st.none(), st.just(NAN), st.floats(-1e9, 1e9), st.integers(0, 3).map(float)),
        min_size=1,
        max_size=40,
    )
)
def test_median_of_anything(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert medians.exact_lower_medians(df, ["x"]) == {"x": lower_median(values)}


def test_median_by_narrowing(spark, monkeypatch):
    monkeypatch.setattr(medians, "_RANKED_IN_ONE_TASK", 3)
    draw = random.Random(1)
    uniform = [draw.random() for _ in range(30_001)]
    tailed = [math.exp(40 * draw.random()) for _ in range(30_001)]
    hot = [5.0 if i % 3 else float(i) for i in range(30_001)]
    even = [float(i) for i in range(30_000)] + [NAN]
    df = spark.createDataFrame(list(zip(uniform, tailed, hot, even)), "a double, b double, c double, d double")
    got = medians.exact_lower_medians(df, ["a", "b", "c", "d"])
    assert got == {
        "a": lower_median(uniform),
        "b": lower_median(tailed),
        "c": 5.0,
        "d": lower_median(even),
    }


def test_median_widens_after_a_miss(spark, monkeypatch):
    monkeypatch.setattr(medians, "_RANKED_IN_ONE_TASK", 3)
    asked = []
    around = medians._around

    def off_target(at, slack):
        asked.append(slack)
        return [0.0, 0.01] if len(asked) == 1 else around(at, slack)

    monkeypatch.setattr(medians, "_around", off_target)
    df = spark.range(10_001).select(F.col("id").cast("double").alias("x"))
    assert medians.exact_lower_medians(df, ["x"]) == {"x": 5000.0}
    # The second look, over the same bracket, was four times as wide.
    assert asked[1] == 4 * asked[0]


@pytest.mark.parametrize(
    "sql",
    [
        "CAST(id % 50 + 1 AS DOUBLE)",
        "IF(id % 3 = 0, CAST(id % 9 AS DOUBLE), -0.0D)",
        "CAST(id * 7919 % 100003 AS DOUBLE) / 100",
    ],
)
def test_exact_medians_of_even_values_need_no_sketch(spark, monkeypatch, sql):
    """Sketches of every row took most of the time; bins find the median on their own."""

    def refused(*_):
        raise AssertionError("a sketch was asked for")

    monkeypatch.setattr(medians.F, "percentile_approx", refused)
    df = spark.range(200_000).selectExpr(f"{sql} AS x")
    assert medians.exact_lower_medians(df, ["x"]) == {"x": lower_median([r.x for r in df.collect()])}


@pytest.mark.parametrize(
    "sql",
    [
        "exp(CAST(id % 1400 AS DOUBLE) - 700)",
        "IF(id = 7, 1e300D, CAST(id AS DOUBLE))",
        "IF(id % 2 = 0, -1.7e308D, 1.7e308D) / (id % 5 + 1)",
        "CASE WHEN id < 10 THEN CAST('-Infinity' AS DOUBLE) WHEN id < 20 THEN CAST('Infinity' AS DOUBLE) ELSE CAST(id AS DOUBLE) END",
        "CAST(id AS DOUBLE) * 5e-324D",
        "CASE WHEN id % 4 = 0 THEN NULL WHEN id % 4 = 1 THEN CAST('NaN' AS DOUBLE) ELSE CAST(id * id AS DOUBLE) END",
    ],
)
def test_exact_medians_of_bunched_and_extreme_values(spark, sql):
    df = spark.range(200_000).selectExpr(f"{sql} AS x", "CAST(id AS DOUBLE) AS y")
    values = [r.x for r in df.collect() if r.x is not None and r.x == r.x]
    assert medians.exact_lower_medians(df, ["x", "y"]) == {"x": lower_median(values), "y": 99999.0}
