"""Small tables for the tests of this folder."""


def make_docs(spark, rows):
    """(doc_id, text) rows as a documents table with an extra column of a clashing name."""
    full = [(i, t, "en", "s", len(t or ""), "x") for i, t in rows]
    return spark.createDataFrame(
        full, "doc_id long, text string, lang string, source string, n_chars long, rep string"
    )


def table_dir(path, spark, **tables):
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path)
