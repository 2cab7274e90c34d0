"""Tables written to the folder all executors share, to cut lineage safely, and their lifetime."""

from __future__ import annotations

import contextlib
import contextvars
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_RUN: contextvars.ContextVar[Run | None] = contextvars.ContextVar("covey_run", default=None)


class Run:
    """Everything one run writes for its own use: paths, and names of catalog tables.

    While a run is ``active``, all that ``fresh_path`` and ``materialise`` hand out belongs to it.
    ``close()`` removes what is left; frames that read it are of no use afterwards.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._around: Run | None = None
        self._paths: list[str] = []
        self._tables: list[str] = []

    @contextlib.contextmanager
    def active(self) -> Iterator[Run]:
        self._around = _RUN.get()
        before = _RUN.set(self)
        try:
            yield self
        finally:
            _RUN.reset(before)

    @contextlib.contextmanager
    def outside(self) -> Iterator[None]:
        """What is written in this block belongs to the run around this one, if there is any."""
        before = _RUN.set(self._around)
        try:
            yield
        finally:
            _RUN.reset(before)

    def owns(self, path: str) -> None:
        self._paths.append(path)

    def owns_table(self, name: str) -> None:
        self._tables.append(name)

    def close(self) -> None:
        for name in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._tables.clear()
        for path in self._paths:
            remove(self.spark, path)
        self._paths.clear()


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[Run]:
    """A run whose tables go at the end of the block::

    with scratch(spark):
        some_operator(df).write.parquet(out)
    """
    run = Run(spark)
    try:
        with run.active():
            yield run
    finally:
        run.close()


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder: ``spark.checkpoint.dir``, else the one set on the
    context, else a folder of the default Hadoop file system.

    That default is refused where it would be each machine's own disk: a file system of local
    files under a master that is not local."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.get(
        spark.sparkContext._jsc.hadoopConfiguration()
    )
    if hadoop.getUri().getScheme() == "file" and not _one_machine(spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{hadoop.getUri().toString().rstrip('/')}/tmp/covey-shared"


def _one_machine(master: str) -> bool:
    return master.split("[")[0] in ("local", "local-cluster")


def fresh_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/covey/{label}-{uuid.uuid4().hex}"
    if run := _RUN.get():
        run.owns(path)
    return path


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold while the block lasts."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def active_run() -> Run | None:
    return _RUN.get()


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    Unlike a cache, the table survives the loss of any executor: what follows re-reads files
    rather than re-running everything upstream. Unlike ``checkpoint()``, it is computed once,
    is columnar, and counts from its footers.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
