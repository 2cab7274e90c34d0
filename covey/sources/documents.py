"""An external document store as a Spark data source, in and out.

``DocumentSource`` is the format ``covey_documents``. What talks to the store is a client, named by
the option ``client`` as ``module:Class`` and made from the options on the driver and in every task:
anything with the methods of ``DocumentClient``. ``covey.sinks.folder_store`` has one over files.

Writing: each task puts its rows in batches of ``batch_rows`` under keys of its own attempt; the
driver then commits the keys of the attempts that succeeded, in one step. So a repeated or
speculative task adds nothing, and a job that fails leaves the collection as it was. Reading: the
store's segments are dealt to partitions of about ``partition_rows`` rows, only the columns of the
given schema are asked for, and the conditions that the store can judge as Spark does are judged there.
"""

from __future__ import annotations

import importlib
import json
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

FORMAT = "covey_documents"
BATCH_ROWS = 5_000
PARTITION_ROWS = 500_000


@dataclass(frozen=True)
class Segment:
    """What the store reads at once, and about how many rows it holds."""

    key: str
    rows: int


@dataclass(frozen=True)
class Condition:
    """``column op value``; ``op`` is one of ``OPERATORS``, ``value`` a list for ``in``."""

    column: str
    op: str
    value: object = None


# What a condition may ask.
OPERATORS = ("=", "<", "<=", ">", ">=", "in", "null", "not null", "starts with")


class DocumentClient(Protocol):
    def put(self, collection: str, run: str, key: str, batch: pa.RecordBatch) -> None:
        """Keep a batch for the commit; nothing reads it until then."""

    def commit(self, collection: str, run: str, keys: Sequence[str], schema: str, replace: bool) -> None:
        """Make the run's batches of these keys, and no others, part of the collection, or all of it.
        Once only, however often it is called for a run."""

    def abort(self, collection: str, run: str) -> None:
        """Forget the run's batches."""

    def schema(self, collection: str) -> str | None:
        """The collection's schema, as JSON of Spark's; None without a collection."""

    def segments(self, collection: str) -> list[Segment]: ...

    def scan(
        self, collection: str, keys: Sequence[str], columns: Sequence[str], conditions: Sequence[Condition]
    ) -> Iterator[pa.RecordBatch]:
        """Rows of these segments that meet all conditions; absent columns may be left out."""


def register(spark: SparkSession) -> None:
    """Make the format known to the session, and let conditions reach it."""
    spark.dataSource.register(DocumentSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


class DocumentSource(D.DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    @property
    def client(self) -> DocumentClient:
        module, _, name = self.options["client"].partition(":")
        return getattr(importlib.import_module(module), name)(dict(self.options))

    def schema(self) -> T.StructType:
        found = self.client.schema(self.options["collection"])
        if found is None:
            raise ValueError(f"no collection {self.options['collection']!r} in the store")
        return T.StructType.fromJson(json.loads(found))

    def reader(self, schema: T.StructType) -> DocumentReader:
        return DocumentReader(self, schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> DocumentWriter:
        return DocumentWriter(self, schema, overwrite)


@dataclass
class Keys(D.WriterCommitMessage):
    keys: list[str]
    rows: int


class DocumentWriter(D.DataSourceArrowWriter):
    def __init__(self, source: DocumentSource, schema: T.StructType, overwrite: bool):
        self.source, self.overwrite = source, overwrite
        self.columns, self.schema = schema.names, schema.json()
        self.run = uuid.uuid4().hex
        self.batch_rows = int(source.options.get("batch_rows", BATCH_ROWS))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Keys:
        client, collection = self.source.client, self.source.options["collection"]
        task = TaskContext.get()
        attempt = f"{task.partitionId():06d}-{task.taskAttemptId()}" if task else uuid.uuid4().hex
        keys, rows = [], 0
        for batch in iterator:
            for a in range(0, batch.num_rows, self.batch_rows):
                part = batch.slice(a, self.batch_rows).rename_columns(self.columns)
                keys.append(f"{attempt}-{len(keys):06d}")
                client.put(collection, self.run, keys[-1], part)
                rows += part.num_rows
        return Keys(keys, rows)

    def commit(self, messages: list[Keys | None]) -> None:
        keys = [key for m in messages if m is not None for key in m.keys]
        self.source.client.commit(
            self.source.options["collection"], self.run, keys, self.schema, self.overwrite
        )

    def abort(self, messages: list[Keys | None]) -> None:
        self.source.client.abort(self.source.options["collection"], self.run)


@dataclass
class Segments(D.InputPartition):
    keys: list[str]


class DocumentReader(D.DataSourceReader):
    def __init__(self, source: DocumentSource, schema: T.StructType):
        self.source, self.asked = source, schema
        self.conditions: list[Condition] = []

    def pushFilters(self, filters: list[D.Filter]) -> Iterable[D.Filter]:  # noqa: N802
        for one in filters:
            condition = condition_of(one, self.asked)
            if condition is None:
                yield one
            else:
                self.conditions.append(condition)

    def partitions(self) -> Sequence[Segments]:
        most = int(self.source.options.get("partition_rows", PARTITION_ROWS))
        dealt: list[Segments] = []
        room = 0
        for segment in self.source.client.segments(self.source.options["collection"]):
            if not dealt or segment.rows > room:
                dealt.append(Segments([]))
                room = most
            dealt[-1].keys.append(segment.key)
            room -= segment.rows
        return dealt or [Segments([])]

    def read(self, partition: Segments) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self.asked)
        found = self.source.client.scan(
            self.source.options["collection"], partition.keys, schema.names, self.conditions
        )
        for batch in found:
            columns = [
                batch.column(f.name).cast(f.type)
                if f.name in batch.schema.names
                else pa.nulls(batch.num_rows, f.type)
                for f in schema
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


_EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.BooleanType)
_COMPARED = {
    D.EqualTo: "=",
    D.LessThan: "<",
    D.LessThanOrEqual: "<=",
    D.GreaterThan: ">",
    D.GreaterThanOrEqual: ">=",
    D.StringStartsWith: "starts with",
}


def condition_of(one: D.Filter, schema: T.StructType) -> Condition | None:
    """A filter as a condition, if any store judges it as Spark does: on a whole column of numbers
    without fractions, texts or booleans (NaN and -0.0 compare otherwise elsewhere)."""
    path = getattr(one, "attribute", ())
    if len(path) != 1 or path[0] not in schema.names:
        return None
    name = path[0]
    if isinstance(one, (D.IsNull, D.IsNotNull)):
        return Condition(name, "null" if isinstance(one, D.IsNull) else "not null")
    if not isinstance(schema[name].dataType, _EXACT):
        return None
    if isinstance(one, D.In):
        return None if None in one.value else Condition(name, "in", list(one.value))
    op = _COMPARED.get(type(one))
    return None if op is None or one.value is None else Condition(name, op, one.value)
