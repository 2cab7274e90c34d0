"""Distinct rows stored once, in a layout that follows from the data alone.

A KMeans fit draws its first centres per partition and sums in row order, so rows have to come in
the same partitions and order whatever cluster wrote them. Here the shuffle that removes the
duplicates is also the one that makes the layout: a row's partition is the hash of all its
columns, the table is bucketed by these columns into as many buckets, and every bucket is one file
sorted by them. Reading it bucket by bucket needs no further shuffle or sort.
"""

from __future__ import annotations

import contextlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covey.functions.columns import column
from covey.sources.shared import active_run, fresh_path, remove, settings


@dataclass(frozen=True)
class StoredRows:
    """A bucketed, sorted table in the session's catalog, over files in the shared folder."""

    spark: SparkSession
    name: str
    path: str
    columns: tuple[str, ...]

    def rows(self) -> DataFrame:
        """The rows, for work that does not depend on their order. Reads the chosen columns."""
        stored = self.spark.table(self.name)
        return stored.select(*[F.col(f"`{s}`").alias(c) for s, c in zip(stored.columns, self.columns)])

    @contextlib.contextmanager
    def in_layout(self) -> Iterator[DataFrame]:
        """The rows for work in which order and partitions count, while the block lasts: Spark
        otherwise packs a bucketed table's files anew where no operator asks for its buckets, or
        where a bucketing column is not read. Frames persisted from them keep the layout."""
        # Always true, and reads every column.
        every = F.xxhash64(*[column(c) for c in self.columns]) >= F.lit(-(1 << 63))
        with settings(self.spark, {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}):
            yield self.rows().where(every)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        remove(self.spark, self.path)


def store_distinct(df: DataFrame, partitions: int) -> StoredRows:
    """One of each row of ``df``, stored in ``partitions`` buckets: one shuffle, behind which
    copies are dropped once more before it, so that a hot row is one record per task."""
    # By one struct: Spark may shuffle by many columns in an order of its own, and its parts would
    # not be the buckets. A struct hashes as its fields do in theirs.
    whole = df.select(F.struct(*[column(c).alias(f"c{i}") for i, c in enumerate(df.columns)]).alias("row"))
    distinct = whole.distinct().select("row.*").toDF(*df.columns)
    return _stored(distinct, partitions)


def store_rows(df: DataFrame, partitions: int) -> StoredRows:
    """The rows of ``df``, known to be distinct, stored in ``partitions`` buckets."""
    return _stored(df.repartition(partitions, *[column(c) for c in df.columns]), partitions)


def _stored(df: DataFrame, partitions: int) -> StoredRows:
    spark, columns = df.sparkSession, tuple(df.columns)
    # Columns are stored under plain names: a catalog's writer takes dots and accents for syntax.
    stored = [f"c{i}" for i in range(len(columns))]
    name, path = f"covey_rows_{uuid.uuid4().hex}", fresh_path(spark, "rows")
    # The shuffle has to make exactly the buckets, so its number is set and left alone.
    exact = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.requireAllClusterKeysForDistribution": "true",
    }
    with settings(spark, exact):
        (
            df.toDF(*stored)
            .write.format("parquet")
            .option("path", path)
            .bucketBy(partitions, *stored)
            .sortBy(*stored)
            .saveAsTable(name)
        )
    if run := active_run():
        run.owns_table(name)
    rows = StoredRows(spark, name, path, columns)
    if _one_file_a_bucket(spark, path):
        return rows
    # The input came dealt by all its columns already, into some other number of parts.
    again = store_rows(spark.read.parquet(path).toDF(*columns), partitions)
    rows.drop()
    return again


def _one_file_a_bucket(spark: SparkSession, path: str) -> bool:
    # Spark ends the name of a bucket's file with its number.
    buckets = [re.search(r"_(\d+)(?:\.c\d+)?(?:\.[a-z0-9]+)*$", f) for f in _data_files(spark, path)]
    return len({b.group(1) for b in buckets if b}) == len(buckets)


def _data_files(spark: SparkSession, path: str) -> list[str]:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    return [n for n in (s.getPath().getName() for s in listed) if n.startswith("part-")]
