"""Connected components of an edge table, and filters by a bitmap of fixed size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covey.llm.columns import mix
from covey.sources.shared import fresh_path, remove

BITMAP_BITS = 24


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node that each node of ``edges (a, b)`` can reach.

    Edges are first contracted within each task, which leaves a star for each component of the
    task's edges. Then large-star and small-star steps alternate (each node hands its neighbours
    to the smallest of them) until nothing changes; every round is a written table, and its
    predecessor is removed. No task holds a component: groups are only aggregated and joined.
    Null ends, loops and repeated edges count for nothing.
    """
    spark = edges.sparkSession
    now = (
        edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
        .filter("a <> b")
        .mapInArrow(_contract, "v long, m long")
        .distinct()
    )
    before, path = None, None
    while True:
        # Large step: of the edges both ways, each node's larger neighbours go to its smallest one.
        both = now.select(F.col("v").alias("u"), F.col("m").alias("w")).unionByName(
            now.select(F.col("m").alias("u"), F.col("v").alias("w"))
        )
        least = both.groupBy("u").agg(F.min("w").alias("least"))
        large = (
            both.join(least, "u")
            .filter("w > u")
            .select(F.col("w").alias("v"), F.least("u", "least").alias("m"))
            .distinct()
        )
        # Small step: a node's smaller neighbours, and the node itself, go to the smallest one.
        low = large.groupBy("v").agg(F.min("m").alias("least"))
        small = (
            large.join(low, "v")
            .select(F.explode(F.array("v", "m")).alias("v"), F.col("least").alias("m"))
            .filter("v <> m")
            .distinct()
        )
        written = fresh_path(spark, "components")
        small.write.parquet(written)
        if path:
            remove(spark, path)
        path, now = written, spark.read.schema("v long, m long").parquet(written)
        state = now.agg(
            F.count("*"), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)"))
        ).first()
        if state == before:
            return now.select(F.col("v").alias("node"), F.col("m").alias("root"))
        before = state


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0
    for batch in batches:
        held.append(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], 1))
        rows += batch.num_rows
        if rows > 1 << 20:
            yield _stars(np.concatenate(held))
            held, rows = [], 0
    if rows:
        yield _stars(np.concatenate(held))


def _stars(edges: np.ndarray) -> pa.RecordBatch:
    names, ends = np.unique(edges.ravel(), return_inverse=True)
    root = roots(len(names), *ends.reshape(-1, 2).T)
    far = root != np.arange(len(names))
    return pa.record_batch({"v": names[far], "m": names[root[far]]})


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` nodes can reach over the edges a-b."""
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return root
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(up := root[root], root):
            root = up


def bitmap(values: DataFrame, column: str, bits: int = BITMAP_BITS) -> Broadcast:
    """A broadcast set of ``2**bits`` bits in which each value's bit is set. Whatever the number
    of values, it takes the same room; with many values it lets more others pass, which costs
    time but never a row, as what passes is joined on the values themselves."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _places(batch.column(0).drop_null().to_numpy(), bits)
            word, bit = np.unique(at)[:, None] // 32, np.unique(at) % 32
            yield pa.record_batch({"word": word.ravel().astype(np.int64), "bit": (1 << bit).astype(np.int64)})

    spark = values.sparkSession
    found = (
        values.select(F.col(column).cast("long"))
        .mapInArrow(words, "word long, bit long")
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bit"))
        .toArrow()
    )
    table = np.zeros((1 << bits) // 32, np.uint32)
    table[found.column("word").to_numpy()] = found.column("bit").to_numpy().astype(np.uint32)
    return spark.sparkContext.broadcast(table)


def _places(values: np.ndarray, bits: int) -> np.ndarray:
    return (mix(values.astype(np.int64).view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def passes(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether each value's bit is set."""
    at = _places(values, (len(table) * 32).bit_length() - 1)
    return (table[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1
