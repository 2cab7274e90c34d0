"""Whitening against numpy's own eigenvectors, and its edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from covey.llm import queries, whitening
from tests.llm.fixtures import table_dir

SCHEMA = "vec_id long, embedding array<double>"


def expected(vectors, k=4):
    """Rows of (n, deviation, whitened...) by eigenvectors of the covariance, and shares."""
    x = np.floor(256 * np.asarray(vectors, np.float64)).astype(np.int64)
    fitted = np.unique(x, axis=0)
    n, sums = len(fitted), fitted.sum(0)
    centred = fitted - sums / n
    values, parts = np.linalg.eigh(centred.T @ centred / n)
    values, parts = values[::-1], parts[:, ::-1]
    whitened = (x - sums / n) @ parts[:, :k] / np.sqrt(values[:k])
    return n, ((n * x - sums) ** 2).sum(1), whitened, values[:k] / values.sum()


def compare(rows, ids, vectors, k=4):
    n, deviation, whitened, share = expected(vectors, k)
    place = {i: a for a, i in enumerate(ids)}
    got = np.full((len(ids), k), np.nan)
    for r in rows:
        a = place[r["vec_id"]]
        assert r["n"] == n and r["deviation"] == deviation[a]
        assert abs(r["explained"] / share[r["component"] - 1] - 1) < 1e-9
        assert r["identity_error"] < 1e-9
        got[a, r["component"] - 1] = r["whitened"]
    for j in range(k):
        sign = np.sign(got[:, j] @ whitened[:, j])
        assert np.abs(got[:, j] - sign * whitened[:, j]).max() < 1e-9


def test_query_against_eigenvectors(spark, sf_dir):
    rows = queries.op11_cholesky_whitening(spark, sf_dir).collect()
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    assert len(rows) == 4 * len(vectors)
    compare(rows, [r["vec_id"] for r in vectors], [r["embedding"] for r in vectors])


def test_odd_rows_copies_and_clashing_names(spark, tmp_path):
    pick = np.random.default_rng(3)
    vectors = (pick.normal(0, 1, (80, 6)) @ pick.normal(0, 1, (6, 6))).tolist()
    rows = list(enumerate(vectors)) + [(100 + i, vectors[0]) for i in range(60)]
    odd = [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (902, [float("nan")] * 6), (903, [float("inf")] * 6), (904, []), (905, [1.0])]
    df = spark.createDataFrame(rows + odd, SCHEMA)
    for name in ("x", "key", "n", "component", "whitened", "sound"):
        df = df.withColumn(name, F.lit("mine"))
    got = queries.op11_cholesky_whitening(spark, table_dir(tmp_path, spark, embeddings=df)).collect()
    assert len(got) == 4 * len(rows)
    compare(got, [i for i, _ in rows], [v for _, v in rows])


def test_directions_without_variance(spark):
    pick = np.random.default_rng(5)
    two = pick.integers(-60, 60, (100, 2))
    x = np.column_stack([two, two.sum(1), np.full(100, 7)])
    df = spark.createDataFrame([(i, (v / 256).tolist()) for i, v in enumerate(x)], SCHEMA)
    found = whitening.fit(df)
    got = whitening.transform(df, found).collect()
    assert len(got) == 400
    assert all((r["whitened"] is None) == (r["component"] > 2) for r in got)
    assert found.identity_error < 1e-9
    assert all(abs(r["explained"]) < 1e-20 for r in got if r["component"] > 2)


def test_nearly_dependent_columns_need_several_passes(spark):
    pick = np.random.default_rng(6)
    base = pick.integers(-(1 << 40), 1 << 40, (300, 3))
    x = np.column_stack([base, base[:, 0] + pick.integers(-1, 2, 300)])
    df = spark.createDataFrame([(i, (v / 256).tolist()) for i, v in enumerate(x)], SCHEMA)
    found = whitening.fit(df)
    assert len(found.factors) > 1
    centred = x - x.mean(0)
    # The small direction is (1, 0, 0, -1): its variance is a half of that of the noise.
    small = found.components[3]
    assert abs(abs(small @ np.array([1, 0, 0, -1]) / np.sqrt(2)) - 1) < 1e-9
    assert abs(found.eigenvalues[3] / ((centred @ small) ** 2).mean() - 1) < 1e-3
    assert found.identity_error < 1e-4


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])]])
def test_nothing_to_fit(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert whitening.transform(df, whitening.fit(df)).collect() == []


def test_one_vector_and_null_ids(spark):
    df = spark.createDataFrame([(None, [0.5, 0.5]), (1, [0.5, 0.5]), (1, [0.5, 0.5])], SCHEMA)
    got = whitening.transform(df, whitening.fit(df)).collect()
    assert len(got) == 6
    assert {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in got} == {(1, 0, None, 0.0, None)}


def test_deviation_beyond_long():
    x, sums = np.array([[1 << 40, -3], [5, 7]]), [1 << 50, 4]
    n = 1 << 30
    want = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    assert whitening.deviations(x, n, sums) == want
    assert whitening.deviations(x % 100, n, [9, 4]) == [sum((n * v - s) ** 2 for v, s in zip(r, [9, 4])) for r in (x % 100).tolist()]
