"""KMeans iterations and silhouettes over rows packed as matrices.

A fit reads every row once per iteration, up to twenty times for each k. Rows are therefore packed
once into blocks of plain numbers, 8 bytes a number, that all fits of a sweep read: nothing is
decoded row by row, and what does not fit the memory comes back from disk as it is. Blocks keep
the rows' partitions and order and are cut at a fixed size, and the partitions' sums are added in
the partitions' order, so that the same rows give the same centres to the last bit.
"""

from __future__ import annotations

import contextlib
import functools
import math
import weakref
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.mllib.common import _py2java
from pyspark.mllib.linalg import Vectors
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from covey.functions import xorshift
from covey.functions.columns import column

# A block and what is made of it stay in a core's cache.
_CELLS_PER_BLOCK = 1 << 16
# A Python task takes about 0.1 s to start, so where there are more partitions than cores it has
# some of them, but no more than it could read again when it fails.
_PARTITIONS_A_TASK = 16
_BLOCK = "partition int, width int, cells binary"
_PLANNED: weakref.WeakKeyDictionary[DataFrame, Packed] = weakref.WeakKeyDictionary()
_SHARED: weakref.WeakKeyDictionary[DataFrame, Packed] = weakref.WeakKeyDictionary()


class Packed:
    """Vectors of a frame's column in blocks, an RDD, and the rows fits start from. The plan is made
    here, of the frame as it is now."""

    def __init__(self, vectors: DataFrame, name: str):
        rows = vectors.select(F.spark_partition_id().alias("partition"), vector_to_array(column(name)).alias("row"))
        # Stored as Python writes bytes: as Spark writes them they take many times longer to read.
        self.blocks = rows.mapInArrow(_pack, _BLOCK).rdd.map(_plain)
        # The number's high bits are the partition, the other 33 the place in it.
        self._numbers = vectors.select(F.monotonically_increasing_id())._jdf.javaRDD()
        self._drawn: dict[int, np.ndarray] = {}

    def drawn(self, draw: int) -> np.ndarray:
        """One row, its number drawn by Spark: the same for every k, so it is drawn once."""
        if draw not in self._drawn:
            sample = self._numbers.takeSample(False, 1, draw)
            if sample.isEmpty():
                raise ValueError("no rows to cluster")
            partition, place = divmod(sample.get(0).getLong(0), 1 << 33)
            (self._drawn[draw],) = _by_task(self.blocks, functools.partial(_row, partition, place))
        return self._drawn[draw]


def plan_packing(vectors: DataFrame, name: str) -> None:
    """Pack from what the frame reads now, whether or not it is persisted later: vectors that are
    only packed are then never stored as rows as well."""
    _PLANNED[vectors] = Packed(vectors, name)


@contextlib.contextmanager
def packed(vectors: DataFrame, name: str) -> Iterator[Packed]:
    """A column of vectors in blocks, persisted while the ``with`` block lasts, packed by the first
    job that reads them. Within it, blocks of the same frame are the same ones."""
    if vectors in _SHARED:
        yield _SHARED[vectors]
        return
    _SHARED[vectors] = made = _PLANNED.get(vectors) or Packed(vectors, name)
    made.blocks.persist(StorageLevel.MEMORY_AND_DISK_DESER)
    try:
        yield made
    finally:
        del _SHARED[vectors]
        made.blocks.unpersist()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of as many rows as fill them, whatever the batches' sizes."""
    waiting: list[np.ndarray] = []
    partition = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        partition = batch.column(0)[0].as_py()
        waiting.append(batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1))
        size = max(1, _CELLS_PER_BLOCK // waiting[0].shape[1])
        if sum(map(len, waiting)) >= size:
            rows = np.concatenate(waiting)
            full = len(rows) - len(rows) % size
            for at in range(0, full, size):
                yield _packed(partition, rows[at : at + size])
            waiting = [rows[full:]]
    if sum(map(len, waiting)):
        yield _packed(partition, np.concatenate(waiting))


def _plain(block: Row) -> tuple[int, int, bytes]:
    return block[0], block[1], bytes(block[2])


def _packed(partition: int, rows: np.ndarray) -> pa.RecordBatch:
    # Component by component: a row of the matrix is a slot of all vectors.
    cells = np.ascontiguousarray(rows.T).tobytes()
    return pa.record_batch(
        [pa.array([partition], pa.int32()), pa.array([rows.shape[1]], pa.int32()), pa.array([cells], pa.binary())],
        ["partition", "width", "cells"],
    )


def first_centers(rows: Packed, k: int, seed: int, steps: int) -> np.ndarray:
    """The centres from which Spark ML's k-means|| starts for this seed: its random numbers for
    every row, its sums, and its own choice among the candidates. Its job keeps an object a row and
    decodes the rows six times for every k; here costs are taken anew from the blocks."""
    jvm = rows.blocks.context._jvm
    draw = jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
    centers = rows.drawn(draw)[None, :]
    for step in range(steps):
        (total,) = _added(rows.blocks, functools.partial(_cost, centers))
        chosen = _by_task(rows.blocks, functools.partial(_chosen, centers, 2.0 * k, total, draw ^ (step << 16)))
        centers = np.concatenate([centers, *[found for _, found in sorted(chosen, key=lambda c: c[0])]])
    # Equal ones once, the first stays; -0.0 is 0.0.
    candidates = np.array(list({tuple(center + 0.0): center for center in centers[::-1]}.values())[::-1])
    if len(candidates) <= k:
        return candidates
    (weights,) = _added(rows.blocks, functools.partial(_counts, candidates))
    clustering = jvm.org.apache.spark.mllib.clustering
    gateway = rows.blocks.context._gateway
    points = gateway.new_array(clustering.VectorWithNorm, len(candidates))
    weighted = gateway.new_array(jvm.double, len(candidates))
    for i, center in enumerate(candidates):
        points[i] = clustering.VectorWithNorm(_py2java(rows.blocks.context, Vectors.dense(center)))
        weighted[i] = float(weights[i])
    best = clustering.LocalKMeans.kMeansPlusPlus(0, points, weighted, k, 30)
    return np.array([list(center.vector().toArray()) for center in best])


def iterate(blocks: RDD, centers: np.ndarray, tolerance: float, most: int) -> np.ndarray:
    """The centres after at most ``most`` iterations, or after one that moves none of them by more
    than ``tolerance``. A centre without rows stays where it is."""
    for _ in range(most):
        sums, n = _added(blocks, functools.partial(_cluster_sums, centers))
        moved = np.where(n[:, None] > 0, sums * (1.0 / np.maximum(n, 1))[:, None], centers)
        converged = (((moved - centers) ** 2).sum(axis=1) <= tolerance * tolerance).all()
        centers = moved
        if converged:
            break
    return centers


def mean_silhouette(blocks: RDD, centers: np.ndarray) -> float:
    """Mean silhouette by squared distances of every row in its nearest centre's cluster, as Spark's
    evaluator defines it: a row's mean distance to a cluster follows from the cluster's count, sum
    and sum of squares. NaN when only one cluster has rows."""
    sums, n, squares = _added(blocks, functools.partial(_cluster_moments, centers))
    if (n > 0).sum() < 2:
        return math.nan
    (total,) = _added(blocks, functools.partial(_coefficients, centers, sums, n, squares))
    return float(total / n.sum())


def _added(blocks: RDD, numbers: Callable[[np.ndarray], list]) -> list:
    """The sums of a block's ``numbers`` over all blocks, added up partition by partition: a few
    numbers a cluster come to the driver from each, which holds 128 MB of rows on large data."""

    def by_partition(part: Iterable[tuple[int, int, bytes]]) -> list[tuple[int, list]]:
        found: dict[int, list] = {}
        for partition, width, cells in part:
            here = numbers(np.frombuffer(cells).reshape(width, -1))
            before = found.get(partition)
            found[partition] = [a + b for a, b in zip(before, here)] if before else here
        return list(found.items())

    parts = sorted(_by_task(blocks, by_partition), key=lambda found: found[0])
    total = parts[0][1]
    for _, here in parts[1:]:
        total = [a + b for a, b in zip(total, here)]
    return total


def _by_task(blocks: RDD, work: Callable[[Iterable[tuple[int, int, bytes]]], list]) -> list:
    partitions = blocks.getNumPartitions()
    few = min(partitions, blocks.context.defaultParallelism)
    return blocks.coalesce(max(few, math.ceil(partitions / _PARTITIONS_A_TASK))).mapPartitions(work).collect()


def _row(number: int, place: int, part: Iterable[tuple[int, int, bytes]]) -> list[np.ndarray]:
    found = []
    for partition, width, cells in part:
        if partition == number:
            x = np.frombuffer(cells).reshape(width, -1)
            if 0 <= place < x.shape[1]:
                found.append(x[:, place].copy())
            place -= x.shape[1]
    return found


def _closest(centers: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre and its squared distance, by differences: 0 exactly where a row is a centre,
    and of equally near ones the first."""
    nearest, least = np.zeros(x.shape[1], np.int32), np.full(x.shape[1], np.inf)
    for j, center in enumerate(centers):
        apart = x - center[:, None]
        apart *= apart
        here = apart.sum(axis=0)
        nearest[here < least] = j
        least = np.minimum(here, least)
    return nearest, least


def _cost(centers: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
    return [_closest(centers, x)[1].sum()]


def _counts(centers: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
    return [np.bincount(_closest(centers, x)[0], minlength=len(centers))]


def _chosen(
    centers: np.ndarray, factor: float, total: float, seed: int, part: Iterable[tuple[int, int, bytes]]
) -> list[tuple[int, np.ndarray]]:
    """Rows drawn with a probability in proportion to their cost, by partition."""
    found, states = [], {}
    for partition, width, cells in part:
        x = np.frombuffer(cells).reshape(width, -1)
        state = states[partition] if partition in states else xorshift.hashed(seed ^ partition)
        draws, states[partition] = xorshift.doubles(state, x.shape[1])
        with np.errstate(divide="ignore", invalid="ignore"):
            found.append((partition, x.T[draws < factor * _closest(centers, x)[1] / total]))
    return found


def _cluster_sums(centers: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
    members = _members(_nearest(centers, x), len(centers))
    return [members @ x.T, members.sum(axis=1)]


def _cluster_moments(centers: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
    members = _members(_nearest(centers, x), len(centers))
    return [members @ x.T, members.sum(axis=1), members @ (x * x).sum(axis=0)]


def _coefficients(
    centers: np.ndarray, sums: np.ndarray, n: np.ndarray, squares: np.ndarray, x: np.ndarray
) -> list[np.ndarray]:
    """The sum of the rows' coefficients; a cluster's only row has 0."""
    nearest, rows = _nearest(centers, x), np.arange(x.shape[1])
    at_least_one = np.maximum(n, 1)
    apart = (sums * (-2.0 / at_least_one)[:, None]) @ x
    apart += (x * x).sum(axis=0)
    apart += (squares / at_least_one)[:, None]
    own = apart[nearest, rows] * (n / np.maximum(n - 1, 1))[nearest]
    apart[n == 0] = np.inf
    apart[nearest, rows] = np.inf
    other = apart.min(axis=0)
    with np.errstate(divide="ignore", invalid="ignore"):
        inside = np.where(own < other, 1 - own / other, np.where(own > other, other / own - 1, 0.0))
    return [np.where(n[nearest] > 1, inside, 0.0).sum()]


def _nearest(centers: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The index of the nearest centre for every column of ``x``; of equally near ones the first."""
    apart = (-2.0 * centers) @ x
    apart += (centers * centers).sum(axis=1)[:, None]
    nearest, least = np.zeros(x.shape[1], np.int32), apart[0]
    for j in range(1, len(centers)):
        nearest[apart[j] < least] = j
        least = np.minimum(apart[j], least)
    return nearest


def _members(nearest: np.ndarray, clusters: int) -> np.ndarray:
    """A row a cluster, with 1 for each of its members."""
    return (nearest == np.arange(clusters)[:, None]).astype(float)
