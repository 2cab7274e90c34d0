"""Every registered query against its SQL, values exact."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from catalog.inputs import TABLES

ORACLE = driver.oracle_sql()
QUERIES = driver.queries()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(sf_dir) / name}.parquet'")
    yield con
    con.close()


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float):
            return "NaN" if math.isnan(value) else repr(value + 0.0)
        return repr(value)

    return sorted(columns), sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(name, spark, duck, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    expected = duck.execute(ORACLE[name])
    sql_columns = [d[0] for d in expected.description]
    got_columns, got = canonical(df.columns, df.collect())
    want_columns, want = canonical(sql_columns, expected.fetchall())
    assert got_columns == want_columns
    assert len(got) == len(want)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_returns_rows(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert driver.entry(spark).count() >= 2
