"""Named collections of documents: replace, append, read back chosen columns."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covey.errors import EmptyCollection
from covey.functions.columns import column
from covey.functions.documents import as_documents
from covey.sinks.commitlog import CommitLog, Part, merged_schema

# The collections the jobs keep, the fewest partitions an import is written with,
# and the columns of an audit record.
TRAINING_DATA = "training_data"
CLUSTERS = "training_clusters"
PROFILES = "cluster_profiles"
CENTERS = "cluster_centers"
METRICS = "training_metrics"
MODEL_INFO = "model_info"
PREDICTION_SUMMARY = "prediction_summary"
IMPORTS = "imports"
MIN_SINK_PARTITIONS = 8
IMPORT_SCHEMA = T.StructType(
    [
        T.StructField("collection", T.StringType()),
        T.StructField("source_path", T.StringType()),
        T.StructField("rows", T.LongType()),
    ]
)


# Appends beyond this many parts write them anew as one.
MOST_PARTS = 64


@dataclass(frozen=True)
class CollectionStore:
    """Collections under one root.

    With a file format, a collection is a directory of parts and a commit log. Readers take the
    parts of the last entry, so a write that fails leaves the collection as it was, and writers at
    the same time lose nothing of each other. Parts may differ in their fields: all are read, and
    a row has null in the fields that its part lacks. The parts before the last replacement stay
    for readers that are still on them. With the name of a connector, such as ``covey_documents``,
    pass its options; ``collection_option`` is the option that takes the collection's name. Rows go
    straight from executors to the store and back, never through the driver.
    """

    spark: SparkSession
    root: str | None = None
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    collection_option: str = "collection"

    def replace(self, name: str, df: DataFrame) -> int:
        """Replace a collection with ``df`` as documents; returns the rows the store now holds.

        The write is one Spark commit, so a retried task cannot add a batch twice.
        """
        documents = as_documents(df)
        if self.root is None:
            self._write(name, documents, "overwrite")
        else:
            part = self._part(name, documents)
            log = self._log(name)
            log.commit(lambda _: [part])
            log.forget()
        return self._load(name).count()

    def append(self, name: str, df: DataFrame) -> None:
        documents = as_documents(df)
        if self.root is None:
            self._write(name, documents, "append")
            return
        log = self._log(name)
        if (now := log.latest()) is not None:
            # Refused before anything is written; the commit looks again.
            merged_schema(now.schema, documents.schema)
        part = self._part(name, documents)
        if len(log.commit(lambda parts: [*parts, part]).parts) > MOST_PARTS:
            self.compact(name)

    def compact(self, name: str) -> None:
        """Write all parts anew as one. Parts appended meanwhile stay beside it, and a replacement
        meanwhile makes it void."""
        log = self._log(name)
        now = log.latest()
        if now is None:
            return
        one = self._part(name, self._load(name))

        def changed(parts: list[Part]) -> list[Part]:
            whole = parts[: len(now.parts)] == now.parts
            return [one, *parts[len(now.parts) :]] if whole else parts

        log.commit(changed)
        log.forget()

    def import_table(self, name: str, df: DataFrame, source_path: str) -> int:
        """``replace`` plus one audit record."""
        rows = self.replace(name, at_least_partitions(df, MIN_SINK_PARTITIONS))
        record = self.spark.createDataFrame([(name, source_path, rows)], IMPORT_SCHEMA)
        self.append(IMPORTS, record.coalesce(1))
        return rows

    def read(
        self,
        name: str,
        columns: Sequence[str] | None = None,
        optional: Sequence[str] = (),
        schema: T.StructType | None = None,
    ) -> DataFrame:
        """Chosen columns only (the scan is pruned to them), plus the ``optional`` ones that the
        collection has. ``schema`` says what else to read them as."""
        df = self._load(name, schema)
        if columns is not None:
            wanted = [*columns, *[c for c in optional if c in df.columns]]
            if self.root is None:
                # A connector that plans its own scan is told the columns; others prune.
                chosen = T.StructType([df.schema[c] for c in dict.fromkeys(wanted)])
                df = self._load(name, chosen)
            df = df.select(*[column(c) for c in wanted])
        if df.isEmpty():
            raise EmptyCollection(name)
        return df

    def versions(self, name: str) -> list[int]:
        """The numbers of the collection's last commits."""
        return self._log(name).versions()

    def _log(self, name: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.root.rstrip('/')}/{name}")

    def _target(self, name: str) -> dict[str, str]:
        if self.root is not None:
            return dict(self.options)
        return {**self.options, self.collection_option: name}

    def _load(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        if self.root is None:
            reader = self.spark.read.format(self.format).options(**self._target(name))
            return (reader if schema is None else reader.schema(schema)).load()
        now = self._log(name).latest()
        if now is None:
            raise EmptyCollection(name)
        merged = now.schema
        folders: dict[str, list[Part]] = {}
        for part in now.parts:
            folders.setdefault(part.schema.json(), []).append(part)
        read = [self._read_parts(name, parts, merged) for parts in folders.values()]
        df = read[0]
        for more in read[1:]:
            df = df.unionByName(more)
        return df if schema is None else _as_schema(df, schema)

    def _read_parts(self, name: str, parts: list[Part], merged: T.StructType) -> DataFrame:
        """Parts of one schema, with the fields of all."""
        own = {f.name: f.dataType for f in parts[0].schema.fields}
        # Nested fields come as null from the reader; numbers are widened behind it.
        asked = [
            T.StructField(n, merged[n].dataType if isinstance(t, (T.StructType, T.ArrayType, T.MapType)) else t)
            for n, t in own.items()
        ]
        reader = self.spark.read.format(self.format).options(**self._target(name))
        root = self._log(name).path
        df = reader.schema(T.StructType(asked)).load([f"{root}/{p.folder}" for p in parts])
        return _as_schema(df, merged)

    def _part(self, name: str, documents: DataFrame) -> Part:
        folder = f"part-{uuid.uuid4().hex}"
        writer = documents.write.format(self.format).options(**self._target(name))
        writer.save(f"{self._log(name).path}/{folder}")
        return Part(folder, documents.schema)

    def _write(self, name: str, df: DataFrame, mode: str) -> None:
        df.write.format(self.format).mode(mode).options(**self._target(name)).save()


def _as_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns: cast where the type differs, null where there is none."""
    have = {f.name: f.dataType for f in df.schema.fields}

    def value(f: T.StructField) -> Column:
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        same = have[f.name].simpleString() == f.dataType.simpleString()
        return column(f.name) if same else column(f.name).cast(f.dataType).alias(f.name)

    return df.select(*[value(f) for f in schema.fields])


def at_least_partitions(df: DataFrame, least: int) -> DataFrame:
    """Spread a narrow scan over ``least`` partitions; a scan already that wide is not shuffled.

    Meant for frames without a shuffle of their own, where asking for the width plans no job.
    """
    return df if df.rdd.getNumPartitions() >= least else df.repartition(least)


def stamped(df: DataFrame, run_id: str) -> DataFrame:
    return df.withColumn("run_id", F.lit(run_id))
