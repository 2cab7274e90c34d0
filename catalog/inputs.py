"""Input tables of the queries, and a few derived from them.

The derived ones are given as SQL that Spark and DuckDB both run, so that both sides of a check
start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from covey.sources.tables import read_parquet

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# lineitem with an incomplete column, a nearly complete one, one with NaN and a constant one.
GAPS = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "quantity": "CASE WHEN l_linenumber = 5 THEN NULL ELSE l_quantity END",
    "price": "CASE WHEN l_linenumber = 7 AND l_tax > 0.03 THEN NULL ELSE l_extendedprice END",
    "discount": "l_discount",
    "tax": "CASE WHEN l_discount = 0 THEN CAST('NaN' AS DOUBLE) ELSE l_tax END",
    "fixed": "CAST(1 AS DOUBLE)",
}

# lineitem spread so far apart by return flag that the best clustering is known: the flags.
FLAGS = {
    "product_name": "l_returnflag",
    "level": "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 60 ELSE 120 END + l_discount",
    "load": "CASE l_returnflag WHEN 'N' THEN 400 ELSE 0 END + l_quantity",
    "spread": (
        "CASE WHEN l_returnflag = 'A' AND l_linenumber = 7 THEN NULL "
        "WHEN l_returnflag = 'R' THEN 3 + l_tax ELSE l_tax END"
    ),
}
FLAG_FEATURES = ["level", "load", "spread"]

LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def derived(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{text} AS {name}" for name, text in columns.items()])


def derived_sql(columns: dict[str, str], source: str = "lineitem", distinct: bool = False) -> str:
    items = ", ".join(f"{text} AS {name}" for name, text in columns.items())
    return f"SELECT {'DISTINCT ' if distinct else ''}{items} FROM {source}"
