"""Removal of repeated byte strings by prefix doubling over sparse positions.

The positions are those of windows that may repeat at all (see ``anchors``): Spark sorts the
contexts by their anchors, which settles equal contexts; different contexts with one anchor then
meet, and their positions are ranked by growing prefixes. For a span of 100 bytes a position
starts with the rank of the 32 bytes there (by a 64-bit hash); the rank of 64 bytes is the rank of
the pair of ranks at offsets 0 and 32, and that of 100 the rank of the pair at 0 and 36. A
position whose rank is unique drops out of the next round, and the rounds end at the span.
Positions are ranked only among those with the same anchor, as others cannot be equal; that is
what lets each key be sorted on its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from covey.llm import anchors, texts
from covey.llm.columns import mix
from covey.sources.shared import materialise

SPAN = 100
GRAM = 32
_BASE = 0xD1342543DE82EF95


def repeated(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """Of ``numbered`` texts: stretches ``num, start, stop`` that cover every byte of a string of
    ``span`` bytes that also starts earlier. Two tables, whose union may overlap."""
    found = materialise(
        anchors.repeats(anchors.occurrences(docs, anchors.byte_symbols, span, gram), span, both=False),
        "suffix-anchors",
    )
    usual, hot = anchors.by_heat(found, 1)
    sorted_ = anchors.contexts(docs, usual, None).repartition("key").sortWithinPartitions("key")

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in anchors.whole_keys(batches):
            num, start = _doubled(batch, span)
            if len(num):
                yield anchors.runs(num, start, span)

    ranked = sorted_.mapInArrow(rank, "num long, start long, stop long")
    if hot is not None:
        ranked = ranked.unionByName(anchors.window_repeats(docs, hot, None, span, both=False))
    return found.filter("key IS NULL"), ranked


def _ranks(first: np.ndarray, second: np.ndarray | None = None) -> np.ndarray:
    """Dense ranks of values, or of pairs of ranks."""
    return np.unique(first if second is None else first << 32 | second, return_inverse=True)[1]


def _levels(span: int) -> list[tuple[int, list[int]]]:
    """Lengths of the rounds, and for each the offsets from a window's start at which ranks of
    that length are needed."""
    lengths = [1 << max((span // 3).bit_length() - 1, 0)]
    while lengths[-1] < span:
        lengths.append(min(2 * lengths[-1], span))
    offsets = [[0]]
    for short, long in zip(lengths[-2::-1], lengths[:0:-1], strict=True):
        offsets.append(sorted({x for o in offsets[-1] for x in (o, o + long - short)}))
    return list(zip(lengths, offsets[::-1], strict=True))


def _start_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the ``length`` bytes (a power of two) at every place, by doubling."""
    out, done = anchors.byte_symbols(data, data)[0], 1
    while done < length:
        out = out[:-done] * np.uint64(pow(_BASE, done, 1 << 64)) + out[done:]
        done *= 2
    return mix(out).view(np.int64)


def _doubled(batch: pa.RecordBatch, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents and starts, in order, of the windows that also start earlier."""
    column = batch.column("stretch")
    data = np.frombuffer(column.buffers()[2], np.uint8)
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data, at = data[at[0] : at[-1]], at - at[0]
    count = np.diff(at) - span + 1
    row = np.repeat(np.arange(len(count)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    begin = at[row] + nth  # windows of all contexts
    # Windows can be equal only if their anchors have the same gram and the same place in them.
    key = _ranks(batch.column("key").to_numpy())
    group = key[row] * 256 + batch.column("place").to_numpy()[row] - nth
    alive = np.arange(len(begin))
    rank, before = np.zeros(len(data), np.int64), 0
    for length, offsets in _levels(span):
        places = np.unique((begin[alive][:, None] + np.array(offsets)).ravel())
        if before == 0:
            got = _ranks(_start_hashes(data, length)[places])
        else:
            got = _ranks(rank[places], rank[places + length - before])
        rank = np.zeros(len(data), np.int64)
        rank[places] = got
        tag = _ranks(_ranks(group[alive]), rank[begin[alive]])
        alive = alive[np.bincount(tag)[tag] > 1]  # unique ones drop out
        before = length
        if not len(alive):
            return alive, alive
    num = batch.column("num").to_numpy()[row[alive]]
    start = batch.column("start").to_numpy()[row[alive]] + nth[alive]
    same = _ranks(_ranks(group[alive]), rank[begin[alive]])
    order = np.lexsort((start, num, same))
    later = np.zeros(len(order), bool)
    later[1:] = same[order][1:] == same[order][:-1]
    num, start = num[order][later], start[order][later]
    order = np.lexsort((start, num))
    return num[order], start[order]


def remove_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the bytes left) for every row of ``docs``.

    Every byte that lies in a string of ``span`` bytes which also starts earlier (in a document
    of smaller doc_id, or earlier in the same one) goes; strings never cross documents and are
    judged on the input. Null and empty texts have no bytes. Rows with a null or repeated doc_id
    are documents of their own, in the order of doc_id (null first) and text.
    """
    known, by_id = anchors.numbered(docs)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.pieces(batches, "packed", 1 << 21):
            data, at = texts.unpacked(batch.column("packed"))
            kept, removed, spans = [], [], []
            for a, b, cover in zip(at[:-1], at[1:], anchors.covers_of(batch), strict=True):
                if cover is None:
                    kept.append(data[a:b].tobytes())
                    removed.append(0), spans.append(0)
                    continue
                keep = np.ones(b - a, bool)
                for x, y in zip(*cover, strict=True):
                    keep[x:y] = False
                kept.append(data[a:b][keep].tobytes())
                removed.append(int((~keep).sum())), spans.append(len(cover[0]))
            yield pa.record_batch(
                {
                    "num": batch.column("num"),
                    "n_bytes": np.diff(at),
                    "n_removed": pa.array(removed, pa.int64()),
                    "n_spans": pa.array(spans, pa.int64()),
                    "kept": pa.array(kept, pa.binary()),
                }
            )

    done = anchors.with_cover(known, *repeated(known, span, gram)).mapInArrow(
        apply, "num long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
    return anchors.named(done, known, by_id)
