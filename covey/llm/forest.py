"""Near-duplicate vectors by a forest of random-projection trees.

Each tree splits the vectors by random directions until its leaves are small. Vectors within a
margin of a split go to both sides, so that few similar ones part. Of ``_TRIED`` directions, and of
places between the quantiles ``_INNER`` of a node's projections, the split takes the one that sends
the fewest vectors to both sides for what it parts, so it tends to pass between groups of near duplicates. Within leaves all pairs are compared exactly, in double precision, and the links
found in all trees are united: a link counts in the first leaf, by number, that both vectors share.

A round grows every node that is still too large by several levels at once. Its splits are fitted
on a sample of about ``SAMPLE`` vectors of the node (the documented bound); every vector is routed.
A node whose split would send more than half of its sample to both sides is not split: its
vectors are about as similar as links are, and a leaf compares them a block at a time. A leaf of
more than ``LARGEST`` vectors is compared whole as well, by many tasks: its vectors are dealt to
blocks of about that many, and each pair of blocks is a key of its own. Pairs of blocks whose
vectors all share the same earlier leaf are left out, as every link of theirs counts there.

Equal vectors are collapsed first and weigh as many as they are.
"""

from __future__ import annotations

import functools
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covey.llm.anchors import whole_keys
from covey.llm.columns import mix
from covey.llm.components import components, roots
from covey.sources.shared import materialise

TREES = 6
LEAF = 256
SAMPLE = 8192
LARGEST = 1 << 15
_WIDTH = 64  # of longer vectors, fewer make a block
_LEVELS = 9
_MARGIN = 0.6  # of the usual distance of two linked vectors along a direction
_INNER = (0.2, 0.8)
_TRIED = 8
_FEWEST = 24
_BLOCK = 1024


def _vectors(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix of doubles."""
    return np.frombuffer(b"".join(column.to_pylist()), "<f4").reshape(len(column), -1).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(embeddings: DataFrame) -> DataFrame:
    """``rep, size, dim, vec`` of the different vectors that can link at all: not null, not
    empty, finite, not zero, with a vec_id. ``rep`` is the smallest vec_id of equal vectors."""
    x = F.col("embedding")
    good = (
        F.col("vec_id").isNotNull()
        & (F.size(x) > 0)
        & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists(x, lambda v: v != 0)
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            at, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype("<f4")
            vecs = [values[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.record_batch({"vec_id": batch.column(0), "dim": np.diff(at).astype(np.int64), "vec": pa.array(vecs, pa.binary())})

    packed = embeddings.filter(good).select("vec_id", F.col("embedding").cast("array<float>")).mapInArrow(
        pack, "vec_id long, dim long, vec binary"
    )
    return packed.groupBy("vec", "dim").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size"))


@functools.lru_cache(maxsize=4096)
def _directions(tree: int, node: int, dim: int) -> np.ndarray:
    """The directions tried at a node, as columns."""
    seed = int(mix(np.array([node], np.int64).view(np.uint64))[0] >> np.uint64(1)) ^ (tree + 1)
    out = np.random.default_rng(seed).normal(size=(dim, _TRIED))
    return out / np.linalg.norm(out, axis=0)


def _child(node: int, side: int) -> int:
    return int(mix(np.array([node * 2 + side & (1 << 64) - 1], np.uint64)).view(np.int64)[0])


#: Node -> where the projection on which of its directions is split.
_Splits = dict[int, tuple[float, int]]


def _fit(tree: int, node: int, x: np.ndarray, levels: int, margin: float) -> _Splits:
    """Splits of a node and below."""
    if levels == 0 or len(x) < _FEWEST:
        return {}
    where = x @ _directions(tree, node, x.shape[1])
    cut, which, _ = min((_cut(where[:, j], margin, j) for j in range(_TRIED)), key=lambda c: c[2])
    p = where[:, which]
    if (np.abs(p - cut) <= margin).mean() > 0.5:
        return {}
    out = {node: (cut, which)}
    for s, side in enumerate((p <= cut + margin, p > cut - margin)):
        out |= _fit(tree, _child(node, s), x[side], levels - 1, margin)
    return out


def _cut(where: np.ndarray, margin: float, which: int) -> tuple[float, int, float]:
    """The best place on one direction: the place, the direction, and copies made for each bit told."""
    p = np.sort(where)
    a, b = (int(q * (len(p) - 1)) for q in _INNER)
    cuts = (p[a : max(b, a + 1)] + p[a + 1 : max(b, a + 1) + 1]) / 2
    below = np.arange(a + 1, a + 1 + len(cuts)) / len(p)
    both = (np.searchsorted(p, cuts + margin, "right") - np.searchsorted(p, cuts - margin, "left")) / len(p)
    bits = -(below * np.log2(below) + (1 - below) * np.log2(np.maximum(1 - below, 1e-12)))
    cost = np.log2(1 + both) / np.maximum(bits, 1e-12)
    # Of equally good places the middle of the widest gap.
    best = np.flatnonzero(cost <= cost.min() * (1 + 1e-9))
    i = int(best[np.argmax(p[a + 1 + best] - p[a + best])])
    return float(cuts[i]), which, float(cost[i])


def _route(
    tree: int, node: int, x: np.ndarray, rows: np.ndarray, splits: _Splits, margin: float
) -> Iterator[tuple[int, np.ndarray]]:
    if not len(rows):
        return
    if node not in splits:
        yield node, rows
        return
    cut, which = splits[node]
    p = x[rows] @ _directions(tree, node, x.shape[1])[:, which] - cut
    yield from _route(tree, _child(node, 0), x, rows[p <= margin], splits, margin)
    yield from _route(tree, _child(node, 1), x, rows[p > -margin], splits, margin)


_ROW = "tree long, node long, rep long, dim long, done boolean"


def _grow(rows: DataFrame, unique: DataFrame, large: DataFrame, threshold: float, leaf: int) -> DataFrame:
    """The rows of the large nodes, routed to new nodes; ``done`` where a node stays whole. Rows
    only name their vectors (``unique``), which are joined to them by ``rep``."""
    vectors = unique.select("rep", "vec")

    def margin_of(dim: int) -> float:
        return _MARGIN * math.sqrt(2 * (1 - threshold) / dim)

    open_ = rows.join(large, ["tree", "node", "dim"])
    share = F.pmod(F.xxhash64("rep", "tree"), F.lit(1 << 20)) * F.col("n") < F.lit(SAMPLE << 20)
    sample = open_.filter(share).join(vectors, "rep")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        tree, node, n = int(pdf["tree"].iloc[0]), int(pdf["node"].iloc[0]), int(pdf["n"].iloc[0])
        x = _unit(np.frombuffer(b"".join(pdf["vec"]), "<f4").reshape(len(pdf), -1).astype(np.float64))
        levels = min(_LEVELS, math.ceil(math.log2(n / leaf)) + 1)
        splits = _fit(tree, node, x, levels, margin_of(x.shape[1]))
        return pd.DataFrame({"tree": [tree], "node": [node], "splits": [pickle.dumps(splits)]})

    fitted = materialise(sample.groupBy("tree", "node").applyInPandas(fit, "tree long, node long, splits binary"), "forest-splits")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, _Splits] = {}
        for batch in batches:
            tree, node, dim = (batch.column(c).to_numpy() for c in ("tree", "node", "dim"))
            splits, vec = batch.column("splits"), batch.column("vec")
            # Rows come sorted by node, so a node's are next to one another.
            change = (tree[1:] != tree[:-1]) | (node[1:] != node[:-1]) | (dim[1:] != dim[:-1])
            starts = np.append(0, np.flatnonzero(change) + 1) if len(tree) else np.zeros(0, np.int64)
            taken, names, done = [], [], []
            for a, b in zip(starts.tolist(), np.append(starts[1:], len(tree)).tolist(), strict=True):
                data = splits[a].as_py()
                if data is None:
                    parts, finished = [(int(node[a]), np.arange(b - a))], True
                else:
                    if data not in known:
                        if len(known) > 256:
                            known.clear()
                        known[data] = pickle.loads(data)
                    x, finished = _unit(_vectors(vec.slice(a, b - a))), not known[data]
                    parts = _route(int(tree[a]), int(node[a]), x, np.arange(b - a), known[data], margin_of(int(dim[a])))
                for name, some in parts:
                    taken.append(some + a)
                    names.append(np.full(len(some), name))
                    done.append(np.full(len(some), finished))
            if taken:
                rows = np.concatenate(taken)
                yield pa.record_batch(
                    [
                        pa.array(tree[rows]),
                        pa.array(np.concatenate(names)),
                        batch.column("rep").take(pa.array(rows)),
                        pa.array(dim[rows]),
                        pa.array(np.concatenate(done)),
                    ],
                    ["tree", "node", "rep", "dim", "done"],
                )

    grown = open_.join(vectors, "rep").join(fitted, ["tree", "node"], "left").select("tree", "node", "rep", "dim", "vec", "splits")
    # Sorted where the rows are: a node may hold any share of them, so no task gathers one.
    return grown.sortWithinPartitions("tree", "node", "dim").mapInArrow(route, _ROW)


def links(embeddings: DataFrame, threshold: float = 0.95, trees: int = TREES, leaf: int = LEAF, largest: int = LARGEST) -> DataFrame:
    """``rep, n, root``: partial numbers of links of the different usable vectors, and links of
    each leaf's classes, rep to root (itself if it is the smallest)."""
    unique = materialise(usable(embeddings), "forest-vectors")
    rows = unique.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).select(
        F.col("tree").cast("long"), F.col("dim").alias("node"), "rep", "dim", F.lit(False).alias("done")
    )
    finished: list[DataFrame] = []
    whole: list[DataFrame] = []
    while True:
        counts = rows.groupBy("tree", "node", "dim").agg(F.count("*").alias("n"))
        large = materialise(counts.filter(F.col("n") > leaf), "forest-large")
        finished.append(rows.join(large, ["tree", "node", "dim"], "left_anti").select(*rows.columns))
        if large.isEmpty():
            break
        grown = materialise(_grow(rows, unique, large, threshold, leaf), "forest-rows")
        finished.append(grown.filter("done"))
        whole.append(grown.filter("done"))
        rows = grown.filter("NOT done")
    number = F.xxhash64("tree", "node", "dim").alias("leaf")
    named = functools.reduce(DataFrame.unionByName, finished).select("rep", number)
    leaves = named.groupBy("rep").agg(F.sort_array(F.collect_set("leaf")).alias("leaves"))
    placed = leaves.join(unique, "rep").select("rep", "size", "vec", "leaves", F.posexplode("leaves").alias("at", "leaf")).select(
        "leaf", "rep", "size", F.slice("leaves", F.lit(1), F.col("at")).alias("earlier"), F.col("vec").alias("stretch")
    )
    room = F.least(F.lit(largest), F.greatest(F.lit(1), F.floor(F.lit(largest * _WIDTH) / F.col("dim"))))
    if whole:
        nodes = functools.reduce(DataFrame.unionByName, whole).groupBy("tree", "node", "dim").agg(F.count("*").alias("n"))
        over = materialise(nodes.filter(F.col("n") > room).select(number, room.alias("room")), "forest-over")
    small = placed
    if whole and not over.isEmpty():
        small = placed.join(over, "leaf", "left_anti")
    keyed = small.select(F.col("leaf").alias("key"), F.lit(0).alias("side"), "rep", "size", "earlier", "stretch")
    if whole and not over.isEmpty():
        keyed = keyed.unionByName(_block_pairs(placed.join(over, "leaf")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_keys(batches, 1 << 22):
            key = batch.column("key").to_numpy()
            edge = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(key)], strict=True):
                if b - a > 1:
                    yield from _compare(batch.slice(a, b - a), threshold)

    return (
        keyed.repartition("key").sortWithinPartitions("key", "side").mapInArrow(compare, "rep long, n long, root long")
    )


def _block_pairs(placed: DataFrame) -> DataFrame:
    """The vectors of leaves with too many for one task, once for every pair of blocks that they
    are compared in. ``side`` is 0 where a block is compared with itself, else 1 or 2.

    The vectors of a leaf that were together in one earlier leaf already (the first of each) have
    blocks of their own if they fill one, and these are not compared with one another."""
    placed = materialise(
        placed.withColumn("home", F.when(F.size("earlier") > 0, F.element_at("earlier", 1)).otherwise(F.col("leaf"))), "forest-whole"
    )
    homes = placed.groupBy("leaf", "home", "room").agg(F.count("*").alias("n")).withColumn(
        "part", F.when(F.col("n") >= F.col("room"), F.col("home")).otherwise(F.col("leaf"))
    )
    parts = homes.groupBy("leaf", "part", "room").agg(F.ceil(F.sum("n") / F.col("room")).alias("blocks"))
    every = Window.partitionBy("leaf")
    before = every.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    plan = parts.select(
        "leaf", "part", "blocks", F.coalesce(F.sum("blocks").over(before), F.lit(0)).alias("first"), F.sum("blocks").over(every).alias("all")
    )
    plan = materialise(homes.select("leaf", "home", "part").join(plan, ["leaf", "part"]), "forest-blocks")
    first, end = F.col("first"), F.col("first") + F.col("blocks")
    mine = first + F.pmod(F.xxhash64("rep"), F.col("blocks"))
    others = F.filter(
        F.sequence(F.lit(0).cast("long"), F.col("all") - 1), lambda o: (F.col("part") == F.col("leaf")) | (o < first) | (o >= end)
    )
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    return (
        placed.join(plan, ["leaf", "home"])
        .withColumns({"mine": mine, "other": F.explode(others)})
        .select(
            F.xxhash64("leaf", low, high).alias("key"),
            F.when(low == high, 0).when(F.col("mine") == low, 1).otherwise(2).alias("side"),
            "rep", "size", "earlier", "stretch",
        )
    )


def _compare(leaf: pa.RecordBatch, threshold: float) -> Iterator[pa.RecordBatch]:
    side = leaf.column("side").to_numpy()
    # Two blocks are compared with each other, anything else with itself.
    half = int((side == 1).sum()) if side[0] else len(side)
    if half == 0 or side[0] and half == len(side):
        return
    x = _unit(_vectors(leaf.column("stretch")))
    rep, size = leaf.column("rep").to_numpy(), leaf.column("size").to_numpy()
    lists = leaf.column("earlier")
    flat, at = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    # Earlier leaves by number: per vector a row, filled up with numbers that nothing shares.
    widest = int(np.diff(at).max())
    table = np.full((len(x), widest), -1, np.int64)
    spot = np.arange(len(flat)) - np.repeat(at[:-1], np.diff(at))
    owner = np.repeat(np.arange(len(x)), np.diff(at))
    table[owner, spot] = np.unique(flat, return_inverse=True)[1]
    count = np.zeros(len(x), np.int64)
    known = np.arange(len(x))  # the class of each vector by the links so far
    for i in range(0, half, _BLOCK):
        for j in range(half if side[0] else i, len(x), _BLOCK):
            a, b = np.nonzero(x[i : min(i + _BLOCK, half)] @ x[j : j + _BLOCK].T >= threshold)
            a, b = a + i, b + j
            if not side[0]:
                a, b = a[a < b], b[a < b]
            if not len(a):
                continue
            news = np.flatnonzero(known[a] != known[b])
            if len(news):
                known = roots(len(x), np.concatenate([np.arange(len(x)), a[news]]), np.concatenate([known, b[news]]))
            # A pair that shares an earlier leaf counted there.
            before = np.zeros(len(a), bool)
            for k in range(widest):
                mark = table[a, k]
                part = np.flatnonzero(~before & (mark >= 0))
                before[part] = (table[b[part]] == mark[part, None]).any(1)
            a, b = a[~before], b[~before]
            np.add.at(count, a, size[b])
            np.add.at(count, b, size[a])
    least = np.full(len(x), np.iinfo(np.int64).max)
    np.minimum.at(least, known, rep)
    root = least[known]
    out = (count > 0) | (root != rep)
    if out.any():
        yield pa.record_batch({"rep": rep[out], "n": count[out], "root": root[out]})


def near_duplicates(embeddings: DataFrame, threshold: float = 0.95, trees: int = TREES, leaf: int = LEAF, largest: int = LARGEST) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``embeddings``.

    Two vectors link at a cosine of ``threshold`` or more; vectors of different lengths never do.
    Vectors that are null, empty, zero or hold null or non-finite components link with nothing.
    Repeated rows link with one another (they are vectors of their own with the same id). A row
    with null vec_id links with nothing and has null component_id and kept.
    """
    found = materialise(links(embeddings, threshold, trees, leaf, largest), "forest-links")
    classes = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    sets = (
        usable(embeddings)
        .join(counts, "rep", "left")
        .join(classes, F.col("rep") == F.col("node"), "left")
        .select(
            "vec", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component_id")
        )
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            if lists.null_count:
                lists = pa.array([x or [] for x in lists.to_pylist()], pa.list_(pa.float32()))
            at, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype("<f4")
            vecs = [values[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.record_batch({"vec_id": batch.column(0), "vec": pa.array(vecs, pa.binary())})

    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>")).mapInArrow(
        pack, "vec_id long, vec binary"
    )
    return rows.join(sets, (rows["vec"] == sets["vec"]) & F.col("vec_id").isNotNull(), "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.col("vec_id") == F.coalesce("component_id", "vec_id")).alias("kept"),
    )
