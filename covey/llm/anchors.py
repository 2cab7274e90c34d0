"""Where texts may repeat: occurrences of content-chosen anchors and the windows they own.

Looking for repeated windows of ``span`` symbols (bytes or words) over a whole corpus would mean
a row for every position. Instead each window names one of its ``gram``-grams, the one with the
smallest hash (the leftmost of equals): the choice depends on the window's content alone, so equal
windows name equal grams at equal places. Consecutive windows mostly name the same gram, and
together they form a *context*, the stretch they cover. Each window of the corpus belongs to just
one context. Two equal windows therefore lie in contexts with the same anchor gram, and a context
whose gram occurs nowhere else holds no repeated window.

``occurrences`` finds the contexts, one row each (for a span of 100 bytes about one per 35
bytes). ``repeats`` brings those with the same gram together and settles what can be settled
there: contexts equal as a whole. What is left, different contexts with one gram, is what
``contexts`` fetches for the operators' own search. A gram with more contexts than one task should
hold (``_HOT`` bytes of them) is not searched that way: ``window_repeats`` tells its windows apart
by hashes of their whole content, which Spark sorts.

Equality of whole contexts is judged by 64-bit hashes among contexts of one 64-bit gram hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covey.llm import columns, texts
from covey.llm.columns import mix
from covey.sources.shared import materialise

_BLOCK = 1 << 20
_HOT = 1 << 24  # bytes of contexts of one gram
_PLACE = 21  # bits of a place within a block and its overlap
_P = 0x9E3779B97F4A7C15
_INVERSE = pow(_P, -1, 1 << 64)
_tables: dict[str, np.ndarray] = {}

#: Symbols of a batch of texts: (data, offsets) -> (a 64-bit value per symbol, n+1 offsets).
Symbols = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]

_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))


def byte_symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _BYTES[data], offsets


def word_symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = columns.find_words(data, offsets)
    return columns.word_hashes(data, words), words.first


def numbered(docs: DataFrame) -> tuple[DataFrame, bool]:
    """``num, doc_id, text`` with ``num`` different for every row and rising with doc_id. It is
    doc_id itself unless some are null or repeated; then rows are numbered in the order of doc_id
    (null first) and text. The second value tells whether num is doc_id."""
    plain = docs.select("doc_id", "text")
    odd = plain.groupBy("doc_id").count().filter("doc_id IS NULL OR count > 1").limit(1)
    if odd.isEmpty():
        return plain.select(F.col("doc_id").alias("num"), "doc_id", "text"), True
    rows = materialise(
        plain.repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
        .select(F.monotonically_increasing_id().alias("num"), "doc_id", "text"),
        "numbered",
    )
    return rows, False


def named(rows: DataFrame, known: DataFrame, by_id: bool) -> DataFrame:
    """``rows (num, ...)`` with the doc_id instead of the number."""
    if by_id:
        return rows.withColumnRenamed("num", "doc_id")
    return known.select("num", "doc_id").join(rows, "num").drop("num")


def _powers(name: str, base: int, n: int) -> np.ndarray:
    if name not in _tables or len(_tables[name]) < n:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        _tables[name] = np.multiply.accumulate(out)
    return _tables[name]


def range_hashes(values: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function from starts and ends to hashes of the stretches between, for one block."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _powers("up", _P, 1 << _PLACE)[:n], out=sums[1:])
    down = _powers("down", _INVERSE, 1 << _PLACE)

    def hashes(start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[start]) * down[start]

    return hashes


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def find(values: np.ndarray, first: np.ndarray, span: int, gram: int) -> Iterator[dict[str, np.ndarray]]:
    """The contexts of a batch, block by block: text, start and number of windows, the anchor's
    place after the start, hashes of the gram and of the whole context."""
    longest = 0
    for text_a, text_b, lo, hi in _blocks(first, span):
        part = values[lo:hi]
        longest = max(longest, len(part))
        if len(part) < span:
            continue
        hashes = range_hashes(part)
        at = np.arange(len(part) - gram + 1)
        grams = mix(hashes(at, at + gram))
        low = np.uint64((1 << _PLACE) - 1)
        named = _least((grams & ~low) | at.astype(np.uint64), span - gram + 1)
        named = (named & low).astype(np.int64)
        edges = np.clip(first[text_a : text_b + 1] - lo, 0, len(part))
        size = np.maximum(np.diff(edges) - span + 1, 0)
        owner = np.repeat(np.arange(text_a, text_b), size)
        start = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(edges[:-1], size)
        if not len(start):
            continue
        anchor = named[start]
        new = np.ones(len(start), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
        head = np.flatnonzero(new)
        count = np.diff(np.append(head, len(start)))
        start, anchor, owner = start[head], anchor[head], owner[head]
        whole = hashes(start, start + count + span - 1)
        yield {
            "text": owner,
            "start": start + lo - first[owner],
            "count": count,
            "place": anchor - start,
            "key": grams[anchor],
            "whole": mix(whole ^ (anchor - start).astype(np.uint64) * np.uint64(_P) ^ count.astype(np.uint64)),
        }


def _blocks(first: np.ndarray, span: int) -> Iterator[tuple[int, int, int, int]]:
    """Stretches of whole texts up to a block's size; a longer text in overlapping stretches, so
    each of its windows lies in exactly one of them."""
    a, n = 0, len(first) - 1
    while a < n:
        b = int(np.searchsorted(first, first[a] + _BLOCK, "right")) - 1
        if b > a:
            yield a, b, int(first[a]), int(first[b])
            a = b
            continue
        for lo in range(int(first[a]), int(first[a + 1]), _BLOCK):
            yield a, a + 1, lo, min(lo + _BLOCK + span - 1, int(first[a + 1]))
        a += 1


_ROW = "num long, key long, whole long, info long, twin int"


def occurrences(docs: DataFrame, symbols: Symbols, span: int, gram: int) -> DataFrame:
    """``num, key, whole, info, twin`` of every context of ``numbered`` texts. ``info`` packs the
    start, the number of windows and the anchor's place.

    Of equal contexts in one batch only the first is a row that has to be compared; it carries
    ``twin = 1``, the others ``twin = 2``. So a context that a third of all texts hold makes as
    many such rows as there are batches, not texts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in columns.texts(batches, "text", 1 << 23):
            got = []
            for part in columns.texts(iter([batch]), "text", 1 << 21):
                num = part.column(0).to_numpy()
                values, first = symbols(*columns.text_buffer(part.column(1)))
                for x in find(values, first, span, gram):
                    info = x["start"] << 16 | x["count"] << 8 | x["place"]
                    got.append((num[x["text"]], x["key"].view(np.int64), x["whole"].view(np.int64), info))
            if not got:
                continue
            num, key, whole, info = (np.concatenate(c) for c in zip(*got, strict=True))
            order = np.lexsort((info, num, whole, key))
            num, key, whole, info = num[order], key[order], whole[order], info[order]
            new = np.ones(len(num), bool)
            new[1:] = (key[1:] != key[:-1]) | (whole[1:] != whole[:-1])
            twin = np.where(new, np.append(~new[1:], False), 2).astype(np.int32)
            # Rows that are not compared need no common place: they are spread by document.
            key = np.where(twin == 2, mix(num.view(np.uint64)).view(np.int64), key)
            yield pa.record_batch({"num": num, "key": key, "whole": whole, "info": info, "twin": twin})

    return docs.select("num", "text").mapInArrow(scan, _ROW)


_FOUND = "num long, start long, stop long, key long, place int, twin int"


def repeats(rows: DataFrame, span: int, both: bool) -> DataFrame:
    """Contexts that hold repeats for certain (``key`` null), or that may (``key`` set).

    Rows of one gram are sorted by content, document and place. Of equal contexts all but the
    first are repeats, and with ``both`` the first as well. If a gram has different contexts, the
    first of each is handed on under its key; ``twin`` then says that it is a repeat already.
    The sorted rows stream past; what is kept from batch to batch is one gram's first rows, and
    of these, once they are many, only the last.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = None, False
        for batch in batches:
            num, key, whole, info, twin = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if (alone := twin == 2).any():
                yield _found(num[alone], info[alone], None, None, span)
                num, key, whole, info, twin = (x[~alone] for x in (num, key, whole, info, twin))
            if not len(num):
                continue
            if held is not None:
                num, key, whole, info, twin = (
                    np.concatenate(x) for x in zip(held, (num, key, whole, info, twin), strict=True)
                )
            new = np.ones(len(num), bool)
            new[1:] = (key[1:] != key[:-1]) | (whole[1:] != whole[:-1])
            if not new.all():
                yield _found(num[~new], info[~new], None, None, span)
            head = np.flatnonzero(new)
            size = np.diff(np.append(head, len(num)))
            num, key, whole, info, twin = (x[head] for x in (num, key, whole, info, twin))
            twin = ((twin > 0) | (size > 1)).astype(twin.dtype)
            last = key == key[-1]
            known = many and key[0] == held[1][0]
            if last.sum() > 1 << 17:
                # A gram with very many contexts: they are known to differ, so go on at once.
                last[:-1] = False
                now_many = True
            else:
                now_many = known and bool(last.all())
            yield from settle(num, key, info, twin, ~last, known, now_many)
            held, many = tuple(x[last] for x in (num, key, whole, info, twin)), now_many
        if held is not None:
            num, key, whole, info, twin = held
            yield from settle(num, key, info, twin, np.ones(len(num), bool), many, False)

    def settle(num, key, info, twin, ready, first_many, last_many):
        """Emit the rows that are ``ready``; the first or last key may go on elsewhere."""
        if not ready.any():
            return
        edge = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.repeat(np.diff(np.append(edge, len(key))), np.diff(np.append(edge, len(key))))
        differ = size > 1
        if first_many:
            differ |= key == key[0]
        if last_many:
            differ |= key == key[-1]
        if both and (mine := ready & (twin > 0)).any():
            yield _found(num[mine], info[mine], None, None, span)
        if (open_ := ready & differ).any():
            yield _found(num[open_], info[open_], key[open_], twin[open_], span)

    return (
        rows.repartition("key")
        .sortWithinPartitions("key", "whole", "num", "info")
        .mapInArrow(scan, _FOUND)
    )


def _found(num, info, key, twin, span) -> pa.RecordBatch:
    start, count, place = info >> 16, info >> 8 & 255, info & 255
    n = len(num)
    return pa.record_batch(
        {
            "num": num,
            "start": start,
            "stop": start + count + span - 1,
            "key": pa.nulls(n, pa.int64()) if key is None else pa.array(key),
            "place": pa.array(place.astype(np.int32)),
            "twin": pa.array(np.zeros(n, np.int32) if twin is None else twin.astype(np.int32)),
        }
    )


def contexts(docs: DataFrame, found: DataFrame, symbols: Symbols | None) -> DataFrame:
    """``key, num, start, place, twin, stretch``: the open contexts with their content, as 64-bit
    symbols or (no ``symbols``) plain bytes. Only texts that have some are sent, once each."""
    open_ = found.filter("key IS NOT NULL")
    lists = open_.groupBy("num").agg(F.collect_list(F.struct("key", "start", "stop", "place", "twin")).alias("found"))
    sent = texts.packed(docs.select(F.col("num").alias("doc_id"), "text"), open_.select(F.col("num").alias("doc_id")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.pieces(batches, "packed", 1 << 20):
            data, at = texts.unpacked(batch.column("packed"))
            values, first = (data, at) if symbols is None else symbols(data, at)
            lists = batch.column("found")
            rows = lists.flatten()
            owner = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            key, start, stop, place, twin = (rows.field(i).to_numpy(zero_copy_only=False) for i in range(5))
            num = batch.column("num").to_numpy()[owner]
            for i in range(0, len(key), 1 << 14):
                j = slice(i, i + (1 << 14))
                a, b = first[owner[j]] + start[j], first[owner[j]] + stop[j]
                size = b - a
                flat = np.repeat(a - (np.cumsum(size) - size), size) + np.arange(size.sum())
                edges = np.concatenate([[0], np.cumsum(size)]) * values.itemsize
                stretch = pa.Array.from_buffers(
                    pa.binary(), len(size), [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values[flat]))]
                )
                yield pa.record_batch(
                    {"key": key[j], "num": num[j], "start": start[j], "place": place[j].astype(np.int32), "twin": twin[j].astype(np.int32), "stretch": stretch}
                )

    return (
        lists.join(sent.withColumnRenamed("doc_id", "num"), "num")
        .select("num", "found", "packed")
        .mapInArrow(cut, "key long, num long, start long, place int, twin int, stretch binary")
    )


def by_heat(found: DataFrame, width: int) -> tuple[DataFrame, DataFrame | None]:
    """Open contexts of grams that one task can search, and of those with more than ``_HOT`` bytes
    of contexts, ``width`` a symbol (None if there are none)."""
    open_ = found.filter("key IS NOT NULL")
    sizes = open_.groupBy("key").agg(F.sum((F.col("stop") - F.col("start")) * width).alias("bytes"))
    hot = materialise(sizes.filter(F.col("bytes") > _HOT).select("key"), "hot-grams")
    if hot.isEmpty():
        return open_, None
    return open_.join(hot, "key", "left_anti"), open_.join(hot, "key", "left_semi")


def window_repeats(docs: DataFrame, found: DataFrame, symbols: Symbols | None, span: int, both: bool) -> DataFrame:
    """``num, start, stop`` of the repeated windows in open contexts, all but the first of equal
    ones, or with ``both`` the first as well. Every window is a row; equal ones have one gram and
    one 64-bit hash of their content, so they meet however many contexts the gram has."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max((1 << _PLACE) // (2 * span), 1)
        for whole in batches:
            for i in range(0, whole.num_rows, step):
                batch = whole.slice(i, step)
                stretch = batch.column("stretch").to_pylist()
                data = np.frombuffer(b"".join(stretch), np.uint8 if symbols is None else np.uint64)
                values = _BYTES[data] if symbols is None else data
                at = np.concatenate([[0], np.cumsum([len(x) for x in stretch])]) // data.itemsize
                count = np.diff(at) - span + 1
                row = np.repeat(np.arange(len(count)), count)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                begin = at[row] + nth
                key, num, start, twin = (batch.column(c).to_numpy()[row] for c in ("key", "num", "start", "twin"))
                yield pa.record_batch(
                    {"key": key, "window": mix(range_hashes(values)(begin, begin + span)).view(np.int64), "num": num, "start": start + nth, "twin": twin}
                )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last row of a batch waits for the next one; ``like`` tells if it equals the one before.
        held, like = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = tuple(c.to_numpy() for c in batch.columns)
            if held is not None:
                rows = tuple(np.concatenate(x) for x in zip(held, rows, strict=True))
            key, window, num, start, twin = rows
            same = (key[1:] == key[:-1]) & (window[1:] == window[:-1])
            before, after = np.append(like, same), np.append(same, False)
            repeat = before | both & (after | (twin > 0))
            if repeat[:-1].any():
                yield _windows(num[:-1][repeat[:-1]], start[:-1][repeat[:-1]], span)
            held, like = tuple(x[-1:] for x in rows), bool(before[-1])
        if held is not None and (like or both and held[4][0] > 0):
            yield _windows(held[2], held[3], span)

    return (
        contexts(docs, found, symbols)
        .mapInArrow(windows, "key long, window long, num long, start long, twin int")
        .repartition("key", "window")
        .sortWithinPartitions("key", "window", "num", "start")
        .mapInArrow(scan, "num long, start long, stop long")
    )


def _windows(num: np.ndarray, start: np.ndarray, span: int) -> pa.RecordBatch:
    order = np.lexsort((start, num))
    return runs(num[order], start[order], span)


def _one(table: pa.Table) -> pa.RecordBatch:
    """A table as one batch. Beyond 2 GB of content Arrow makes several; none may be dropped."""
    batches = table.combine_chunks().to_batches()
    if len(batches) > 1:
        raise OverflowError(f"a key has more content than one batch can hold ({table.num_rows} rows)")
    return batches[0]


def whole_keys(batches: Iterator[pa.RecordBatch], most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Batches sorted by ``key``, regrouped so that a key's rows stand in one batch, and a batch
    holds up to about ``most`` bytes of content (more only if one key does)."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.column("stretch").nbytes
        if size < most:
            continue
        table = pa.Table.from_batches([_one(pa.Table.from_batches(held))])
        key = table.column("key").to_numpy()
        cut = int(np.searchsorted(key, key[-1]))
        if cut:
            yield _one(table.slice(0, cut))
        held = table.slice(cut).to_batches()
        size = sum(b.column("stretch").nbytes for b in held) if cut else 0
    if held:
        yield _one(pa.Table.from_batches(held))
    held.clear()
    columns.release()


def covered(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches merged where they touch or overlap."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > reach[:-1]
    head = np.flatnonzero(new)
    return starts[head], reach[np.append(head[1:], len(starts)) - 1]


def runs(num: np.ndarray, start: np.ndarray, span: int) -> pa.RecordBatch:
    """Window starts in order, as stretches: consecutive starts of a document become one."""
    new = np.ones(len(num), bool)
    new[1:] = (num[1:] != num[:-1]) | (start[1:] != start[:-1] + 1)
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(num)) - 1
    return pa.record_batch({"num": num[head], "start": start[head], "stop": start[last] + span})


def with_cover(docs: DataFrame, *covers: DataFrame) -> DataFrame:
    """``num, packed, cover array<struct<start,stop>>`` of every text (no cover: null)."""
    every = covers[0].select("num", "start", "stop")
    for more in covers[1:]:
        every = every.unionByName(more.select("num", "start", "stop"))
    lists = every.groupBy("num").agg(F.collect_list(F.struct("start", "stop")).alias("cover"))
    sent = texts.packed(docs.select(F.col("num").alias("doc_id"), "text")).withColumnRenamed("doc_id", "num")
    return sent.join(lists, "num", "left").select("num", "packed", "cover")


def covers_of(batch: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray] | None]:
    column = batch.column("cover")
    rows, at = column.flatten(), column.offsets.to_numpy()
    start, stop = (rows.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    lengths = np.diff(at)
    out: list[tuple[np.ndarray, np.ndarray] | None] = []
    done = 0
    for n, ok in zip(lengths.tolist(), column.is_valid().to_pylist(), strict=True):
        out.append(covered(start[done : done + n], stop[done : done + n]) if ok and n else None)
        done += n if ok else 0
    return out
