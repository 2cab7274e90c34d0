"""Jaccard self-join of documents on word shingles: a grouped prefix join.

Sets are ordered rare shingles first. Two sets similar enough share a shingle in a short prefix
of that order; only prefixes are shuffled. Sets with the same prefix and size form one group, and
groups are paired instead of sets. The order takes the frequencies of ``2**BUCKET_BITS`` buckets
of shingles: a table of fixed size. With N shingles a bucket holds N / 2**20 on average, give or
take the root of that, so shingles far more common than that root are told apart and put last.
The order never changes the result, only the work.

Only classes are asked for, so links are looked for where they can still change a class: first
each set is compared with two others in a few buckets, its neighbour by size and the one whose
shingles are the most common: among edited copies of a text that is the text itself or what is
closest to it. That joins most groups of near copies. Then the exact prefix join runs over pairs of
groups whose classes differ. Links inside a class are never listed, so a large group of near
copies costs as many rows as it has members.

A shingle is a 64-bit hash. Two shingles of a pair of documents with 10,000 of them each collide
with a chance of about 1e-11.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covey.llm import columns, texts
from covey.llm.columns import mix
from covey.llm.components import components
from covey.sources.shared import materialise

WIDTH = 5
BUCKET_BITS = 20
SEEDS = 3
PARITY_BITS = 512
_SLOT = 1 << 12
_BASE = np.uint64(0xA0761D6478BD642F)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted hashes; one for the whole text if it has fewer
    words, none if it has no word. Letters A-Z count as lower case."""
    words = columns.find_words(data, offsets)
    hashes = columns.word_hashes(data, words, lower=True)
    runs = columns.run_hashes(hashes, width)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= width:
            found = np.sort(runs[a : b - width + 1])
            keep = np.ones(len(found), bool)
            keep[1:] = found[1:] != found[:-1]
            out.append(found[keep])
        elif b > a:
            out.append(columns.whole_hash(hashes[a:b])[None])
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def frequency_classes(docs: DataFrame, width: int = WIDTH) -> np.ndarray:
    """For each bucket of shingles, four times the binary logarithm of how many documents'
    shingles fall into it: ``2**BUCKET_BITS`` bytes."""
    size = 1 << BUCKET_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in columns.texts(batches, "text"):
            sets = shingle_sets(*columns.text_buffer(batch.column(0)), width)
            total += np.bincount(_bucket(np.concatenate(sets)), minlength=size)
        yield slots(total)

    def slots(total: np.ndarray) -> pa.RecordBatch:
        at = np.arange(0, size, _SLOT)
        return pa.record_batch(
            {"slot": pa.array(at // _SLOT, pa.int32()), "counts": [total[i : i + _SLOT].tobytes() for i in at]}
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                got = np.frombuffer(counts, np.int64)
                sums[slot] = sums[slot] + got if slot in sums else got
        if sums:
            yield pa.record_batch(
                {"slot": pa.array(list(sums), pa.int32()), "counts": [x.tobytes() for x in sums.values()]}
            )

    kind = "slot int, counts binary"
    summed = docs.select("text").mapInArrow(count, kind).repartition(size // _SLOT // 4, "slot").mapInArrow(add, kind)
    total = np.zeros(size, np.int64)
    for row in summed.toLocalIterator():
        total[row.slot * _SLOT : (row.slot + 1) * _SLOT] = np.frombuffer(row.counts, np.int64)
    return np.floor(4 * np.log2(total + 1)).astype(np.uint8)


def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def profiles(docs: DataFrame, percent: int = 80, width: int = WIDTH) -> DataFrame:
    """``doc_id, n, g, s, common, parity, seeds, prefix``: set size, hash of prefix and size, hash
    of the set, how common its shingles are on average, the parities of its shingles' numbers in
    ``PARITY_BITS`` bins, its smallest shingles, and its prefix."""
    classes = docs.sparkSession.sparkContext.broadcast(frequency_classes(docs, width))

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = classes.value.astype(np.uint64) << np.uint64(56)
        for batch in columns.texts(batches, "text"):
            sets = shingle_sets(*columns.text_buffer(batch.column(1)), width)
            ordered = [np.sort(rank[_bucket(x)] | x >> np.uint64(8)) for x in sets]
            need = [prefix_size(len(x), percent) for x in sets]
            prefixes = [x[:p] for x, p in zip(ordered, need, strict=True)]
            seeds = [x[:SEEDS] for x in sets]
            n = np.array([len(x) for x in sets])
            yield pa.record_batch(
                {
                    "doc_id": batch.column(0),
                    "n": pa.array(n, pa.int64()),
                    "g": pa.array([_hash(x, _BASE ^ np.uint64(len(s))) for x, s in zip(prefixes, sets, strict=True)], pa.int64()),
                    "s": pa.array([_hash(x, _BASE) for x in sets], pa.int64()),
                    "common": pa.array([int(1000 * classes.value[_bucket(x)].mean()) if len(x) else 0 for x in sets], pa.int64()),
                    "parity": _lists([_parity(x) for x in sets]),
                    "seeds": _lists(seeds),
                    "prefix": _lists(prefixes),
                }
            )

    kind = "doc_id long, n long, g long, s long, common long, parity array<long>, seeds array<long>, prefix array<long>"
    return docs.select("doc_id", "text").mapInArrow(profile, kind)


def _parity(shingles: np.ndarray) -> np.ndarray:
    """Two sets differ in at least as many shingles as their parities differ in bits."""
    bins = (shingles & np.uint64(PARITY_BITS - 1)).astype(np.int64)
    odd = np.bincount(bins, minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.uint64)


def _near(a: str, b: str, percent: int) -> F.Column:
    """Whether the parities of two sets allow their similarity (always, where one is unknown)."""
    differ = sum(
        (F.bit_count(F.col(f"{a}.parity")[i].bitwiseXOR(F.col(f"{b}.parity")[i])) for i in range(PARITY_BITS // 64)),
        F.lit(0),
    )
    most = (F.col(f"{a}.n") + F.col(f"{b}.n")) * (100 - percent)
    return F.coalesce(differ * (100 + percent) <= most, F.lit(True))


def prefix_size(n: int, percent: int) -> int:
    """Sets of n whose overlap is ``percent`` of n or more share one of their first so many."""
    return n - -(-percent * n // 100) + 1 if n else 0


def _hash(values: np.ndarray, salt: np.uint64) -> int:
    return int(mix(values ^ salt).sum(dtype=np.uint64).view(np.int64)) if len(values) else 0


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    at = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(parts).view(np.int64)))


def verified(docs: DataFrame, pairs: DataFrame, percent: int = 80, width: int = WIDTH) -> DataFrame:
    """The pairs ``a, b`` of documents whose sets are similar enough."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))
    found = texts.packed(docs, ids)
    both = (
        pairs.join(found.select(F.col("doc_id").alias("a"), F.col("packed").alias("left")), "a")
        .join(found.select(F.col("doc_id").alias("b"), F.col("packed").alias("right")), "b")
        .select("a", "b", "left", "right")
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.pieces(batches, "left", 1 << 20):
            left = shingle_sets(*texts.unpacked(batch.column(2)), width)
            good = np.zeros(batch.num_rows, bool)
            for part in texts.pieces(iter([batch.append_column("row", pa.array(np.arange(batch.num_rows)))]), "right", 1 << 20):
                right = shingle_sets(*texts.unpacked(part.column(3)), width)
                for row, y in zip(part.column("row").to_pylist(), right, strict=True):
                    x = left[row]
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    good[row] = 100 * shared >= percent * (len(x) + len(y) - shared)
            yield pa.record_batch(
                [batch.column(0).filter(pa.array(good)), batch.column(1).filter(pa.array(good))], ["a", "b"]
            )

    return both.mapInArrow(check, "a long, b long")


def jaccard_classes(docs: DataFrame, percent: int = 80, width: int = WIDTH) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``: two documents link when
    their shingles' Jaccard similarity is ``percent`` or more, and a class is named after its
    smallest doc_id.

    Texts that are null or without words have no shingle and link with nothing. Rows that share a
    doc_id are one document; a null doc_id takes no part and has a null component_id.
    """
    table = materialise(profiles(docs, percent, width), "ngram-profiles")
    known = table.filter("n > 0 AND doc_id IS NOT NULL")
    sets = materialise(known.groupBy("n", "g", "s").agg(F.min("doc_id").alias("rep"), F.any_value("parity").alias("parity")), "ngram-sets")
    same = (F.col("doc_id") == F.col("rep")) & (F.col("t.n") == F.col("r.n"))
    same = same & (F.col("t.g") == F.col("r.g")) & (F.col("t.s") == F.col("r.s"))
    first = materialise(
        verified(docs, _neighbours(known.alias("t").join(sets.alias("r"), same)), percent, width), "ngram-links"
    )
    classes = components(first)
    members = materialise(
        sets.join(classes, F.col("rep") == F.col("node"), "left").select(
            "n", "g", "rep", "parity", F.coalesce("root", "rep").alias("c")
        ),
        "ngram-members",
    )
    more = materialise(
        verified(docs, _prefix_pairs(known, members, percent), percent, width), "ngram-links"
    )
    links = first.unionByName(more)
    final = components(links)
    named = sets.join(final, F.col("rep") == F.col("node"), "left").select(
        "n", "g", "s", F.coalesce("root", "rep").alias("component_id")
    )
    return (
        table.join(named, ["n", "g", "s"], "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        )
    )


def _neighbours(kept: DataFrame) -> DataFrame:
    """Pairs likely to be similar: among the sets with one of their smallest shingles in common
    and about the same size, and among those of one group, neighbours by size, and each with the
    one whose shingles are the most common."""
    rows = kept.select("rep", F.col("t.n").alias("n"), F.col("t.g").alias("g"), "common", "seeds")
    size = F.floor(F.log("n") / F.lit(float(np.log(1.25))))
    plain = ("rep", "n", "common")
    by_seed = rows.select(*plain, F.explode("seeds").alias("key"), size.alias("size")).select(
        *plain, "key", F.explode(F.array("size", F.col("size") + 1)).alias("block")
    )
    by_group = rows.select(*plain, F.col("g").alias("key"), F.lit(-1).cast("long").alias("block"))
    bucket = Window.partitionBy("key", "block")
    return (
        by_seed.unionByName(by_group)
        .withColumn("before", F.lag("rep").over(bucket.orderBy("n", "rep")))
        .withColumn("centre", F.first("rep").over(bucket.orderBy(F.desc("common"), "rep")))
        .select("rep", F.explode(F.array("before", "centre")).alias("a"))
        .filter("a <> rep")
        .select(F.least("a", "rep").alias("a"), F.greatest("a", "rep").alias("b"))
        .distinct()
    )


def _prefix_pairs(known: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets that may be similar and whose classes differ, from pairs of groups."""
    groups = members.groupBy("n", "g").agg(
        F.min("rep").alias("gid"),
        F.min("c").alias("low"),
        F.max("c").alias("high"),
        # Only a group of one set has parities that hold for all its members.
        F.when(F.count("*") == 1, F.any_value("parity")).alias("parity"),
    )
    of = known.alias("t").join(
        groups.alias("r"),
        (F.col("doc_id") == F.col("gid")) & (F.col("t.n") == F.col("r.n")) & (F.col("t.g") == F.col("r.g")),
    )
    postings = of.select(F.posexplode("prefix").alias("pos", "token"), "gid", F.col("t.n").alias("n"), "low", "high")
    token = Window.partitionBy("token")
    mixed = materialise(
        postings.withColumns({"least": F.min("low").over(token), "most": F.max("high").over(token)})
        .filter("least < most")
        .drop("least", "most")
        .join(groups.select("gid", "n", "parity"), ["gid", "n"]),
        "ngram-postings",
    )
    a, b = mixed.alias("a"), mixed.alias("b")
    # b is the smaller set. With the overlap at least p/(100+p) of both sizes, b's part of the
    # common prefix is the shorter one that 2p/(100+p) leaves.
    p, q = percent, 100 + percent
    both = (
        a.join(
            b,
            (F.col("a.token") == F.col("b.token"))
            & ((F.col("a.n") > F.col("b.n")) | ((F.col("a.n") == F.col("b.n")) & (F.col("a.gid") < F.col("b.gid"))))
            & (F.col("b.n") * 100 >= F.col("a.n") * p)
            & (F.col("b.pos") <= F.col("b.n") - F.ceil(F.col("b.n") * (2 * p) / q))
            & ((F.least("a.low", "b.low") < F.greatest("a.high", "b.high")))
            & (
                (F.least("a.pos", "b.pos") + 1 + F.least(F.col("a.n") - F.col("a.pos"), F.col("b.n") - F.col("b.pos")) - 1)
                * q
                >= (F.col("a.n") + F.col("b.n")) * p
            )
            & _near("a", "b", percent),
        )
        .select(F.col("a.gid").alias("ga"), F.col("b.gid").alias("gb"))
        .distinct()
    )
    inside = groups.filter("low < high").select(F.col("gid").alias("ga"), F.col("gid").alias("gb"))
    expanded = members.join(groups.select("n", "g", "gid"), ["n", "g"]).select("gid", "rep", "c", "n", "parity")
    left = both.unionByName(inside).join(expanded.withColumnRenamed("gid", "ga"), "ga").alias("a")
    return (
        left.join(
            expanded.alias("b"),
            (F.col("a.gb") == F.col("b.gid")) & (F.col("a.c") != F.col("b.c")) & _near("a", "b", percent),
        )
        .select(F.least("a.rep", "b.rep").alias("a"), F.greatest("a.rep", "b.rep").alias("b"))
        .distinct()
    )
