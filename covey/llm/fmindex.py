"""Removal of repeated word windows by searching an FM-index of each shard.

A shard is the contexts whose anchors fall to one task (see ``anchors``): equal windows always
share an anchor, so a window's copies lie in its own shard and no document is searched against
the others. Equal contexts are collapsed before, and weigh 2 in the index.

The index of a shard is the Burrows-Wheeler transform of its contexts in a wavelet matrix (one
bit-packed row of the symbols' bits per level, with counts at every 64th bit). The contexts then
stream through it from right to left, all of a shard side by side: backward search lengthens the
current match by one word as long as it occurs twice; otherwise the match falls back to the next
shorter one that occurs more often, its parent interval, known from the lengths of common
prefixes. Wherever the match is as long as the span, a repeated window starts.

Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from covey.llm import anchors, columns, texts
from covey.sources.shared import materialise

SPAN = 35
GRAM = 8


class FmIndex:
    """Index of several texts of symbols, each with a weight."""

    def __init__(self, symbols: np.ndarray, at: np.ndarray, weights: np.ndarray):
        """``symbols``: any numbers, all texts in a row; ``at``: the texts' n+1 offsets."""
        names, codes = np.unique(symbols, return_inverse=True)
        n_texts = len(at) - 1
        self.first = at[:-1] + np.arange(n_texts)  # where each text starts
        self.stop = at[1:] + np.arange(n_texts)  # and its end mark, symbol 0
        self.codes = np.zeros(len(symbols) + n_texts, np.int64)
        spots = np.ones(len(self.codes), bool)
        spots[self.stop] = False
        self.codes[spots] = codes + 1
        size = len(self.codes)
        end = np.repeat(self.stop, np.diff(at) + 1)
        order, levels = _suffixes(self.codes, end)
        self.common = _common_prefixes(order, levels, end)
        self.smaller_before, self.smaller_after = _smaller(self.common)
        before = self.codes[order - 1]
        before[np.isin(order, self.first)] = 0
        self.counts = np.concatenate([[0], np.cumsum(np.bincount(self.codes, minlength=len(names) + 1))])
        owner = np.repeat(np.arange(n_texts), np.diff(at) + 1)
        self.weight = np.concatenate([[0], np.cumsum(weights[owner[order]])])
        self.size = size
        self._wavelet(before, len(names) + 1)

    def _wavelet(self, values: np.ndarray, n_symbols: int) -> None:
        self.rows = []
        for bit in range(max(n_symbols - 1, 1).bit_length() - 1, -1, -1):
            bits = (values >> bit & 1).astype(bool)
            packed = np.packbits(np.append(bits, np.zeros(-len(bits) % 64 + 64, bool)), bitorder="little").view(np.uint64)
            ones = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])
            self.rows.append((bit, packed, ones, int(len(bits) - bits.sum())))
            values = np.concatenate([values[~bits], values[bits]])
        every = np.arange(n_symbols)
        self.origin = np.zeros(n_symbols, np.int64)
        self.origin = self._walk(every, np.zeros(n_symbols, np.int64))

    def _walk(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for bit, packed, ones, zeros in self.rows:
            word = place >> 6
            inside = packed[word] & ((np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1))
            rank = ones[word] + np.bitwise_count(inside)
            place = np.where(symbol >> bit & 1, zeros + rank, place - rank)
        return place

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the matches with a symbol put before them."""
        both = self._walk(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        base = self.counts[symbol] - self.origin[symbol]
        return base + both[: len(low)], base + both[len(low) :]

    def matches(self, least: int = 2) -> np.ndarray:
        """Matching statistics: for every symbol of every text, how long the longest stretch is
        that starts there and weighs at least ``least`` over its occurrences."""
        found = np.zeros(self.size, np.int64)
        place = self.stop - 1
        low = np.zeros(len(place), np.int64)
        high = np.full(len(place), self.size)
        length = np.zeros(len(place), np.int64)
        first = self.first
        while len(place):
            on = place >= first
            if not on.all():
                place, first, low, high, length = (x[on] for x in (place, first, low, high, length))
                if not len(place):
                    break
            a, b = self.extend(self.codes[place], low, high)
            good = self.weight[b] - self.weight[a] >= least
            length = np.where(good, length + 1, length)
            found[place[good]] = length[good]
            # Not often enough: the parent interval, or the next symbol if nothing is matched.
            depth = np.maximum(self.common[low], self.common[high])
            up_low = np.where(self.common[low] == depth, self.smaller_before[low], low)
            up_high = np.where(self.common[high] == depth, self.smaller_after[high], high)
            none = length == 0
            low, high = np.where(good, a, np.where(none, 0, up_low)), np.where(good, b, np.where(none, self.size, up_high))
            length = np.where(good, length, np.where(none, 0, np.maximum(depth, 0)))
            place = place - (good | none)
        return found


def _ranks(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1]


def _suffixes(codes: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffixes' order up to their end marks (equal ones by place), by prefix doubling, and
    the ranks of each round."""
    levels, width, at = [codes], 1, np.arange(len(codes))
    longest = int((end - at).max()) + 1 if len(codes) else 1
    while width < longest:
        rank = levels[-1]
        levels.append(_ranks(rank << 32 | rank[np.minimum(at + width, end)]))
        width *= 2
    return np.argsort(levels[-1], kind="stable"), levels


def _common_prefixes(order: np.ndarray, levels: list[np.ndarray], end: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before; -1 at both outer edges."""
    out = np.full(len(order) + 1, -1, np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        equal = levels[k][np.minimum(a + shared, end[a])] == levels[k][np.minimum(b + shared, end[b])]
        shared += equal << k
    # Beyond the marks everything is equal; what counts ends there.
    out[1:-1] = np.minimum(shared, np.minimum(end[a] - a, end[b] - b))
    return out


def _smaller(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the nearest before and after it with a smaller value."""
    at = np.arange(len(values))
    before, after = np.zeros(len(values), np.int64), np.full(len(values), len(values) - 1)
    for v in np.unique(values):
        here = np.flatnonzero(values == v)
        less = np.flatnonzero(values < v)
        if not len(less):
            continue
        spot = np.searchsorted(less, here)
        before[here] = less[np.maximum(spot - 1, 0)]
        after[here] = less[np.minimum(spot, len(less) - 1)]
    return before, after


def repeated(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """Of ``numbered`` texts: stretches of words ``num, start, stop`` that cover every word of a
    window of ``span`` words that also starts anywhere else. Two tables; they may overlap."""
    rows = anchors.occurrences(docs, anchors.word_symbols, span, gram)
    found = materialise(anchors.repeats(rows, span, both=True), "window-anchors")
    usual, hot = anchors.by_heat(found, 8)
    shards = anchors.contexts(docs, usual, anchors.word_symbols).repartition("key").sortWithinPartitions("key")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in anchors.whole_keys(batches, 1 << 21):
            column = batch.column("stretch")
            at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) // 8
            symbols = np.frombuffer(column.buffers()[2], np.uint64)[at[0] : at[-1]]
            weights = 1 + (batch.column("twin").to_numpy() > 0)
            index = FmIndex(symbols, at - at[0], weights)
            spots = np.flatnonzero(index.matches() >= span)
            if not len(spots):
                continue
            text = np.searchsorted(index.first, spots, "right") - 1
            num = batch.column("num").to_numpy()[text]
            start = batch.column("start").to_numpy()[text] + spots - index.first[text]
            order = np.lexsort((start, num))
            yield anchors.runs(num[order], start[order], span)

    searched = shards.mapInArrow(search, "num long, start long, stop long")
    if hot is not None:
        searched = searched.unionByName(anchors.window_repeats(docs, hot, anchors.word_symbols, span, both=True))
    return found.filter("key IS NULL"), searched


def remove_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` (the words left, joined by one space, as bytes) for
    every row of ``docs``.

    Every word in a window of ``span`` words that also starts anywhere else goes, the first
    occurrence too; windows never cross documents and are judged on the input. Texts that are
    null, empty or all white space have no words; shorter texts than a window stay whole. Rows
    with a null or repeated doc_id are documents of their own.
    """
    known, by_id = anchors.numbered(docs)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.pieces(batches, "packed", 1 << 21):
            data, at = texts.unpacked(batch.column("packed"))
            words = columns.find_words(data, at)
            keep = np.ones(len(words.starts), bool)
            for first, cover in zip(words.first.tolist(), anchors.covers_of(batch), strict=False):
                for x, y in zip(*cover, strict=True) if cover else ():
                    keep[first + x : first + y] = False
            # One space after every kept word; the last of a text goes again.
            raw = data.tobytes()
            kept = []
            for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
                spots = a + np.flatnonzero(keep[a:b])
                kept.append(b" ".join([raw[s:e] for s, e in zip(words.starts[spots].tolist(), words.ends[spots].tolist(), strict=True)]))
            n = np.diff(words.first)
            gone = np.concatenate([[0], np.cumsum(~keep)])[words.first]
            yield pa.record_batch(
                {
                    "num": batch.column("num"),
                    "n_words": pa.array(n, pa.int64()),
                    "n_removed": pa.array(np.diff(gone), pa.int64()),
                    "kept": pa.array(kept, pa.binary()),
                }
            )

    done = anchors.with_cover(known, *repeated(known, span, gram)).mapInArrow(
        apply, "num long, n_words long, n_removed long, kept binary"
    )
    return anchors.named(done, known, by_id)
