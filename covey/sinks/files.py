"""CSV and JSON outputs."""

from __future__ import annotations

import uuid

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covey.functions.columns import column


def write_csv_parts(df: DataFrame, path: str, empty_as: str | None = None) -> None:
    """CSV with a header, as a directory of parts written in parallel: the form for results
    that grow with the input. ``empty_as`` is written for an empty text; a text that equals it is
    an error, as it would be read back as empty."""
    if empty_as is not None:
        df = df.select(*[_unlike(f, empty_as) for f in df.schema.fields])
    writer = df.write.mode("overwrite").option("header", True)
    if empty_as is not None:
        writer = writer.option("emptyValue", empty_as)
    writer.csv(path)


def _unlike(field: T.StructField, mark: str) -> Column:
    value = column(field.name)
    if isinstance(field.dataType, T.StringType):
        clash = F.raise_error(f"a text of column {field.name} equals the mark of empty texts")
        value = F.when(value == mark, clash.cast("string")).otherwise(value)
    return value.alias(field.name)


def write_single_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header, replaced if present.

    The parts are written in parallel without headers, and then joined in the order of the
    partitions behind one header line: by the file system itself where it can join files, else by
    copying their bytes, which no task and no parser sees again.
    """
    staging = _staging(path)
    spark = df.sparkSession
    names = spark.createDataFrame([df.columns], T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(df.columns))]))
    names.coalesce(1).write.csv(f"{staging}/head")
    df.write.csv(f"{staging}/rows")
    files, target = filesystem(spark, path)
    parts = [p for folder in ("head", "rows") for p in _part_paths(spark, f"{staging}/{folder}")]
    whole = _joined(spark, files, parts)
    files.delete(target, False)
    if not files.rename(whole, target):
        raise OSError(f"could not publish {whole} as {path}")
    delete(spark, staging)


def _part_paths(spark: SparkSession, folder: str) -> list:
    """The Hadoop paths of a written folder's parts that hold anything, in order."""
    files, target = filesystem(spark, folder)
    found = [s for s in files.listStatus(target) if s.getPath().getName().startswith("part-") and s.getLen()]
    return sorted((s.getPath() for s in found), key=lambda p: p.getName())


def _joined(spark: SparkSession, files, parts: list):
    """All parts as one file, in the place of the first."""
    first, rest = parts[0], parts[1:]
    if not rest:
        return first
    paths = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(rest))
    for i, part in enumerate(rest):
        paths[i] = part
    try:
        files.concat(first, paths)
        return first
    except UnsupportedOperationException:
        pass
    whole = spark._jvm.org.apache.hadoop.fs.Path(first.getParent(), "joined")
    out = files.create(whole, True)
    try:
        for part in parts:
            stream = files.open(part)
            try:
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 20, False)
            finally:
                stream.close()
    finally:
        out.close()
    return whole


def write_json_document(df: DataFrame, path: str) -> None:
    """The one row of ``df`` as an indented UTF-8 JSON file, replaced if present."""
    text = F.to_json(
        F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns]),
        {"pretty": "true", "ignoreNullFields": "false"},
    )
    staging = _staging(path)
    df.select(text.alias("value")).coalesce(1).write.text(staging)
    _publish_single_part(df.sparkSession, staging, path)


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = filesystem(spark, path)
    return files.exists(target)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in ``path``; none if there is no such path."""
    files, target = filesystem(spark, path)
    if not files.exists(target):
        return []
    return [s.getPath().getName() for s in files.listStatus(target)]


def delete(spark: SparkSession, path: str) -> None:
    files, target = filesystem(spark, path)
    files.delete(target, True)


def _staging(path: str) -> str:
    """A fresh sibling directory, so that nothing the user owns is ever cleared."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent or '.'}/_{name}.{uuid.uuid4().hex}"


def _publish_single_part(spark: SparkSession, staging: str, path: str) -> None:
    files, target = filesystem(spark, path)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    part = next(
        status.getPath()
        for status in files.listStatus(hadoop_path(staging))
        if status.getPath().getName().startswith("part-")
    )
    files.delete(target, False)
    if not files.rename(part, target):
        raise OSError(f"could not publish {part} as {path}")
    files.delete(hadoop_path(staging), True)


def filesystem(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target
