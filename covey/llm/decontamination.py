"""Benchmark passages in documents, found by spaced seeds.

Words are lower-cased runs of letters and digits, so punctuation and spacing don't matter. An
item leaks into a document if some ``STRETCH`` consecutive words of it stand there with at most
``SUBSTITUTED`` of them replaced by other words; an item of fewer words, but at least ``SHORTEST``,
if it stands there as a whole; a still shorter one never does.

A seed hashes the words at the ones of a mask and ignores those at its zeros. The masks are such
that however the replaced words lie in a stretch, some mask fits between them: no leak is missed.
Seeds of all documents are held against a bitmap of the benchmark's seeds, of fixed size; what
passes is joined on the seeds' hashes, and the words around each hit are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covey.llm import anchors, columns, texts
from covey.llm.columns import mix
from covey.llm.components import bitmap, passes
from covey.sources.shared import materialise

STRETCH = 13
SUBSTITUTED = 2
SHORTEST = 5
#: Three masks of seven words that together meet any two replacements in 13 words.
MASKS = ("11101111", "1111010011", "11010011101")
SEED_BITS = 27
_BASE = np.uint64(0x9FB21C651E98DF25)
_SEED = "num long, at long, seed long"


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a batch's words, and the index of each text's first."""
    words = columns.find_words(data, offsets, alnum=True)
    return columns.word_hashes(data, words, lower=True, alnum=True), words.first


def _seeds(values: np.ndarray, owner: np.ndarray, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """Places of a pattern that lie within one text, and the hashes there."""
    n = len(values) - len(pattern) + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    out = np.full(n, int(pattern, 2), np.uint64)
    for i, bit in enumerate(pattern):
        if bit == "1":
            out *= _BASE
            out += values[i : i + n]
    at = np.flatnonzero(owner[:n] == owner[len(pattern) - 1 :])
    return at, mix(out[at])


def _scan(patterns: list[str], wanted, whole_short: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in columns.texts(batches, "text", 1 << 22):
            values, first = words_of(*columns.text_buffer(part.column(1)))
            count = np.diff(first)
            owner = np.repeat(np.arange(len(count)), count)
            num = part.column(0).to_numpy()
            for pattern in patterns:
                at, seed = _seeds(values, owner, pattern)
                if whole_short:  # an item: masks if it is long enough, else the whole of it
                    size = count[owner[at]]
                    fit = size >= STRETCH if "0" in pattern else size == len(pattern)
                    at, seed = at[fit], seed[fit]
                seed = seed.view(np.int64)
                if wanted is not None:
                    fit = passes(wanted.value, seed)
                    at, seed = at[fit], seed[fit]
                if len(at):
                    yield pa.record_batch({"num": num[owner[at]], "at": at - first[owner[at]], "seed": seed})

    return scan


def leaks(docs: DataFrame, benchmark: DataFrame, bits: int = SEED_BITS) -> DataFrame:
    """``doc_id, item_id, start, stop, n_words``: for each document and each item that leaks into
    it, the words ``start..stop`` of the document between which its matching stretches lie (those
    of one alignment; another alignment is another row) and the number of words in them.

    Null and empty texts match nothing. Rows with a null or repeated doc_id are documents of
    their own; repeated items give a row each.
    """
    known, by_id = anchors.numbered(docs)
    items = materialise(
        benchmark.select(F.monotonically_increasing_id().alias("item"), "item_id", "text"), "leak-items"
    )
    whole = ["1" * n for n in range(SHORTEST, STRETCH)]
    of_items = materialise(
        items.select(F.col("item").alias("num"), "text").mapInArrow(_scan([*MASKS, *whole], None, True), _SEED),
        "leak-seeds",
    )
    wanted = bitmap(of_items, "seed", bits)
    hits = known.select("num", "text").mapInArrow(_scan([*MASKS, *whole], wanted, False), _SEED)
    aligned = (
        hits.join(of_items.select(F.col("num").alias("item"), F.col("at").alias("place"), "seed"), "seed")
        .select("num", "item", (F.col("at") - F.col("place")).alias("shift"))
        .distinct()
    )
    aligned = materialise(aligned, "leak-hits")
    lists = (
        aligned.join(items.select("item", "item_id", F.col("text").alias("passage")), "item")
        .groupBy("num")
        .agg(F.collect_list(F.struct("item_id", "shift", "passage")).alias("found"))
    )
    sent = texts.packed(
        known.select(F.col("num").alias("doc_id"), "text"), aligned.select(F.col("num").alias("doc_id"))
    ).withColumnRenamed("doc_id", "num")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.pieces(batches, "packed", 1 << 20):
            values, first = words_of(*texts.unpacked(batch.column("packed")))
            lists = batch.column("found")
            rows = lists.flatten()
            owner = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            shift = rows.field("shift").to_numpy()
            passage, start = words_of(*columns.text_buffer(rows.field("passage")))
            out = []
            for i, doc in enumerate(owner.tolist()):
                span = matched(values[first[doc] : first[doc + 1]], passage[start[i] : start[i + 1]], int(shift[i]))
                if span:
                    out.append((i, doc, *span))
            if out:
                i, doc, a, b, n = (np.array(c) for c in zip(*out, strict=True))
                yield pa.record_batch(
                    {"num": batch.column("num").take(pa.array(doc)), "item_id": rows.field("item_id").take(pa.array(i)), "start": a, "stop": b, "n_words": n}
                )

    done = lists.join(sent, "num").select("num", "found", "packed").mapInArrow(
        compare, "num long, item_id long, start long, stop long, n_words long"
    )
    return anchors.named(done, known, by_id)


def matched(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int] | None:
    """Where the stretches lie that match with the item's first word at the document's word
    ``shift``: first and last word, and how many words they cover."""
    length, allowed = (STRETCH, SUBSTITUTED) if len(item) >= STRETCH else (len(item), 0)
    a, b = max(shift, 0), min(shift + len(item), len(doc))
    if b - a < length or length < SHORTEST:
        return None
    missed = np.concatenate([[0], np.cumsum(doc[a:b] != item[a - shift : b - shift])])
    good = np.flatnonzero(missed[length:] - missed[:-length] <= allowed)
    if not len(good):
        return None
    gaps = np.minimum(np.diff(good), length).sum()
    return a + int(good[0]), a + int(good[-1]) + length, int(gaps) + length


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` into which no item leaks. A row without doc_id stays only if no row
    without one has a leak."""
    bad = leaks(docs, benchmark).select("doc_id").distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["doc_id"]), "left_anti")
