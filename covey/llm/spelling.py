"""Spelling variants: words one edit apart, compared in dense tiles of code points.

Two words are near if they differ by one inserted, deleted or replaced code point, that is, if
their common prefix and common suffix together reach the longer length less one. Words become
padded matrices of code points, one aligned left and one aligned right, and blocks of their rows
are compared whole: all pairs of a tile at once, column by column.

Which rows share a tile: for a pair whose shorter word has ``c`` code points there is a place
``p`` in ``0..c-1`` such that the first ``p`` code points agree and so do the last ``c-1-p``. The places are
cut into intervals; for the interval ``lo..hi`` a word's key is its first ``lo`` and last ``c-1-hi`` code
points, so near words share the key of the interval their place is in, and only that interval
counts the pair. A key that more than ``largest`` words share is split into the two halves of its
interval, and so on; at a single place the key leaves one code point open in the shorter words and
two in the longer, so a tile's size is bounded by the alphabet, however many words share an ending.

Words are maximal runs of ``A-Za-z`` and U+00C0..U+00FF. A run of which 31 divides the crc32 of
``<doc_id>:<run>`` loses one code point, which makes the misspellings that are looked for.

Defined cases: a null text has no words; a null id is an empty one; an empty table gives no rows; texts and
words may be of any length; documents that repeat count again; of near words that are equally frequent the smallest
in code-point order is the form. Columns other than ``doc_id`` and ``text`` are never read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covey.llm.columns import text_buffer, texts
from covey.sources.shared import materialise

SHORTEST = 7
LEAST = 2
#: A form is this many times as frequent as its variant.
RATIO = 10
DAMAGED = 31
_INTERVALS = 3
_LARGEST = 512
_BLOCK = 64
_CELLS = 1 << 20
_LONG_RUN = 64
_LEAD = 0xC3

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> 1), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()
_FLIP = np.uint32(0xFFFFFFFF)


def words(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """``word, n``: words of at least ``shortest`` code points that occur ``least`` times or more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts(batches, "text"):
            found = occurrences(batch.column("doc_id"), batch.column("text"), shortest)
            counts = pc.value_counts(found)
            yield pa.record_batch([counts.field(0).cast(pa.string()), counts.field(1)], ["word", "n"])

    ids = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id")
    partial = docs.select(ids, "text").mapInArrow(count, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def occurrences(ids: pa.Array, column: pa.Array, shortest: int) -> pa.Array:
    """The words of at least ``shortest`` code points in a batch of texts, one by one, without order."""
    data, offsets = text_buffer(column)
    starts, ends, owner, points = _runs(data, offsets)
    long = points >= shortest
    starts, ends, owner, points = starts[long], ends[long], owner[long], points[long]
    lower = _LOWER[data]
    prefix = np.array([zlib.crc32(f"{i}:".encode()) for i in ids.to_pylist()], np.uint32)
    crc = _crc(lower, starts, ends, prefix[owner])
    hit = crc % DAMAGED == 0
    mask = np.zeros(len(data) + 1, np.int8)
    np.add.at(mask, starts[~hit], 1)
    np.add.at(mask, ends[~hit], -1)
    kept = lower[np.cumsum(mask[:-1], dtype=np.int8).astype(bool)]
    at = np.zeros(int((~hit).sum()) + 1, np.int64)
    np.cumsum((ends - starts)[~hit], out=at[1:])
    whole = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(kept)))
    shorter = []
    for a, b, h, n in zip(starts[hit].tolist(), ends[hit].tolist(), crc[hit].tolist(), points[hit].tolist(), strict=True):
        if n > shortest:
            run, k = lower[a:b].tobytes().decode(), h % n
            shorter.append(run[:k] + run[k + 1 :])
    return pa.concat_arrays([whole, pa.array(shorter, pa.large_string())])


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, text and code points of the maximal runs; U+00C0..U+00FF are the two-byte
    sequences that begin with C3."""
    lead = data == _LEAD
    inside = _LETTER[data] | lead
    inside[1:] |= lead[:-1]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begin[edges] = inside[edges]
    end[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    leads = np.zeros(len(data) + 1, np.int64)
    np.cumsum(lead, out=leads[1:])
    owner = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, owner, ends - starts - (leads[ends] - leads[starts])


def _crc(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each run of bytes, carried on from ``before``; a byte of all runs at a time."""
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    at, state = starts[order], before[order] ^ _FLIP
    sizes = size[order]
    many = int(np.searchsorted(-sizes, -_LONG_RUN, "left"))
    for i in range(many):
        run = data[at[i] : at[i] + sizes[i]].tobytes()
        state[i] = np.uint32(zlib.crc32(run, int(state[i] ^ _FLIP))) ^ _FLIP
    left, now, sizes = at[many:], state[many:], sizes[many:]
    for k in range(int(sizes[0]) if len(sizes) else 0):
        live = int(np.searchsorted(-sizes, -k, "left"))
        part = now[:live]
        now[:live] = _CRC[(part ^ data[left[:live] + k]) & 0xFF] ^ (part >> 8)
    out = np.empty(len(starts), np.uint32)
    out[order] = state ^ _FLIP
    return out


def near(counted: DataFrame, largest: int = _LARGEST) -> DataFrame:
    """Of ``word, n``: ``word, n_near, best`` for the words that have near ones; ``best`` holds ``n``
    and ``word`` of the most frequent."""
    length = F.length("word")
    classes = F.filter(F.array(length, length - 1), lambda c: c >= 1)
    spread = counted.select("word", "n", length.alias("size"), F.explode(classes).alias("c"))
    parts = F.transform(
        F.sequence(F.lit(0), F.lit(_INTERVALS - 1)),
        lambda i: F.struct(
            F.floor(i * F.col("c") / _INTERVALS).cast("int").alias("lo"),
            (F.floor((i + 1) * F.col("c") / _INTERVALS) - 1).cast("int").alias("hi"),
        ),
    )
    tiles = _keyed(spread.select("*", F.inline(parts)).filter("hi >= lo"))
    found = []
    while True:
        sizes = tiles.groupBy("c", "lo", "hi", "key").count()
        crowded = materialise(
            sizes.filter((F.col("count") > largest) & (F.col("hi") > F.col("lo"))).drop("count"), "crowded"
        )
        none = crowded.isEmpty()
        plain = tiles if none else tiles.join(crowded, ["c", "lo", "hi", "key"], "left_anti")
        found.append(_compared(plain))
        if none:
            break
        halves = F.inline(
            F.array(
                F.struct(F.col("lo").alias("lo"), F.col("middle").alias("hi")),
                F.struct((F.col("middle") + 1).alias("lo"), F.col("hi").alias("hi")),
            )
        )
        split = tiles.join(crowded, ["c", "lo", "hi", "key"], "left_semi").withColumn(
            "middle", F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        )
        tiles = materialise(_keyed(split.select("word", "n", "size", "c", halves)), "tiles")
    together = found[0]
    for more in found[1:]:
        together = together.unionByName(more)
    # The least of (-n, word) is the most frequent word, and of equal ones the smallest.
    return together.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best_word").alias("word"))).alias("best")
    )


def _keyed(tiles: DataFrame) -> DataFrame:
    # Equal hashes of unequal keys only make a tile larger: the tile compares the words themselves.
    head = F.substring(F.col("word"), F.lit(1), F.col("lo"))
    tail_size = F.col("c") - 1 - F.col("hi")
    tail = F.substring(F.col("word"), F.col("size") - tail_size + 1, tail_size)
    return tiles.withColumn("key", F.xxhash64(head, tail))


def _compared(tiles: DataFrame) -> DataFrame:
    """Each task's words with their near words in its tiles: numbers and the most frequent one."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            group = _groups(batch)
            # The batch's last group may go on; all before it is whole.
            cut = int(group[-1])
            if cut:
                held.append(batch.slice(0, cut))
                yield from _near_rows(pa.Table.from_batches(held))
                held = [batch.slice(cut)]
            elif held and not _goes_on(held[-1], batch):
                yield from _near_rows(pa.Table.from_batches(held))
                held = [batch]
            else:
                held.append(batch)
        if held:
            yield from _near_rows(pa.Table.from_batches(held))

    order = ["c", "lo", "key"]
    rows = tiles.select("word", "n", "size", "c", "lo", "hi", "key")
    return (
        rows.repartition(*order)
        .sortWithinPartitions(*order, "size")
        .mapInArrow(compare, "word string, n_near long, best_n long, best_word string")
    )


def _columns(table: pa.RecordBatch | pa.Table, names: tuple[str, ...]) -> list[np.ndarray]:
    return [table.column(name).to_numpy() for name in names]


def _groups(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    """Where the groups of rows that share a key begin."""
    c, lo, key = _columns(batch, ("c", "lo", "key"))
    change = (c[1:] != c[:-1]) | (lo[1:] != lo[:-1]) | (key[1:] != key[:-1])
    return np.append(0, np.flatnonzero(change) + 1)


def _goes_on(before: pa.RecordBatch, after: pa.RecordBatch) -> bool:
    names = ("c", "lo", "key")
    return [before.column(x)[before.num_rows - 1] for x in names] == [after.column(x)[0] for x in names]


def _near_rows(table: pa.Table) -> Iterator[pa.RecordBatch]:
    starts = _groups(table)
    sizes = np.diff(np.append(starts, table.num_rows))
    keep = sizes > 1
    starts, sizes = starts[keep], sizes[keep]
    if not len(starts):
        return
    n, size, c, lo, hi = _columns(table, ("n", "size", "c", "lo", "hi"))
    column = table.column("word").combine_chunks()
    points, at = _code_points(column)
    pairs = []
    for length in np.unique(c[starts]):
        of = c[starts] == length
        pairs += _pairs(points, at, size, lo, hi, int(length), starts[of], sizes[of])
    if not pairs:
        return
    row = np.concatenate([x for i, j in pairs for x in (i, j)])
    other = np.concatenate([x for i, j in pairs for x in (j, i)])
    # The first of each row's: the most frequent, of equal ones the smallest in code-point order.
    rank = np.empty(table.num_rows, np.int64)
    involved = np.unique(other)
    names = column.take(pa.array(involved)).cast(pa.binary())
    rank[involved[pc.sort_indices(names).to_numpy()]] = np.arange(len(involved))
    by = np.lexsort((rank[other], -n[other], row))
    row, other = row[by], other[by]
    first = np.append(0, np.flatnonzero(row[1:] != row[:-1]) + 1)
    each = np.diff(np.append(first, len(row)))
    yield pa.record_batch(
        [column.take(pa.array(row[first])), pa.array(each), pa.array(n[other[first]]), column.take(pa.array(other[first]))],
        ["word", "n_near", "best_n", "best_word"],
    )


def _code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words' code points, a byte each as all are below 256, and offsets."""
    data, at = text_buffer(column)
    lead = data == _LEAD
    after = np.zeros(len(data), bool)
    after[1:] = lead[:-1]
    leads = np.zeros(len(data) + 1, np.int64)
    np.cumsum(lead, out=leads[1:])
    return np.where(after, data + np.uint8(64), data)[~lead], at - leads[at]


def _pairs(
    points: np.ndarray, at: np.ndarray, size: np.ndarray, lo: np.ndarray, hi: np.ndarray, c: int, starts: np.ndarray, sizes: np.ndarray
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Near pairs of rows in groups of class ``c``: groups of like size are compared together, as
    tiles of one shape; larger groups in pairs of blocks."""
    out: list[tuple[np.ndarray, np.ndarray]] = []
    width = 2
    while len(starts):
        now = sizes <= width if width < _BLOCK else np.ones(len(sizes), bool)
        small = now & (sizes <= _BLOCK)
        if small.any():
            lefts = starts[small]
            out += _tiles(points, at, size, lo, hi, c, lefts, lefts, sizes[small], sizes[small], width)
        for a, many in zip(starts[now & ~small].tolist(), sizes[now & ~small].tolist(), strict=True):
            blocks = np.arange(0, many, _BLOCK)
            i, j = np.triu_indices(len(blocks))
            rest = np.minimum(_BLOCK, many - blocks)
            # A pair of blocks that are both of the longer words belongs to the next class.
            wanted = size[a + blocks[i]] == c
            i, j = i[wanted], j[wanted]
            out += _tiles(points, at, size, lo, hi, c, a + blocks[i], a + blocks[j], rest[i], rest[j], _BLOCK)
        starts, sizes = starts[~now], sizes[~now]
        width *= 2
    return out


def _tiles(
    points: np.ndarray, at: np.ndarray, size: np.ndarray, lo: np.ndarray, hi: np.ndarray, c: int, left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, width: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    step = max(1, _CELLS // (width * width))
    for a in range(0, len(left), step):
        x, y = left[a : a + step], right[a : a + step]
        rows, others = x[:, None] + np.arange(width), y[:, None] + np.arange(width)
        here, there = np.arange(width) < n_left[a : a + step, None], np.arange(width) < n_right[a : a + step, None]
        rows, others = np.where(here, rows, x[:, None]), np.where(there, others, y[:, None])
        open_ = here[:, :, None] & there[:, None, :] & (rows[:, :, None] < others[:, None, :])
        open_ &= (size[rows] == c)[:, :, None] | (size[others] == c)[:, None, :]
        shared = _agree(points, at, size, rows, others, c, open_, False)
        # Tiles of one key share the interval; the place of a pair is in one interval only.
        place = np.minimum(shared, c - 1)
        open_ &= (place >= lo[x][:, None, None]) & (place <= hi[x][:, None, None])
        shared += _agree(points, at, size, rows, others, c, open_, True)
        longer = np.maximum(size[rows][:, :, None], size[others][:, None, :])
        t, i, j = np.nonzero(open_ & (shared >= longer - 1))
        if len(t):
            out.append((rows[t, i], others[t, j]))
    return out


def _agree(
    points: np.ndarray, at: np.ndarray, size: np.ndarray, rows: np.ndarray, others: np.ndarray, c: int, open_: np.ndarray, back: bool
) -> np.ndarray:
    """Common prefix, or suffix, of each open pair: equal columns of the padded matrices."""
    live, count = open_.copy(), np.zeros(open_.shape, np.int32)
    for k in range(c + 1):
        # Padding is 0 and no word holds it; words of one tile are distinct, so it ends no longer run.
        one, two = (_column(points, at, size, r, k, back) for r in (rows, others))
        live &= one[:, :, None] == two[:, None, :]
        if not live.any():
            break
        count += live
    return count


def _column(points: np.ndarray, at: np.ndarray, size: np.ndarray, rows: np.ndarray, k: int, back: bool) -> np.ndarray:
    place = at[rows + 1] - 1 - k if back else at[rows] + k
    return np.where(k < size[rows], points[np.clip(place, 0, len(points) - 1)], 0)


def variants(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word.

    ``form`` is the most frequent near word, if at least ``ratio`` times as frequent; ``root`` where following
    forms ends. Each step is that much more frequent, so the steps are few whatever the table.
    """
    counted = materialise(words(docs, shortest, least), "words")
    joined = counted.join(near(counted), "word", "left")
    enough = -F.col("best.less") >= F.col("n") * ratio
    formed = materialise(
        joined.select(
            "word",
            F.when(enough, F.col("best.word")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, -F.col("best.less")).alias("form_n"),
        ),
        "formed",
    )
    forms = formed.filter("form IS NOT NULL").select("word", "form")
    onward = forms.select(F.col("word").alias("root"), F.col("form").alias("next"))
    moving, ended = forms.withColumnRenamed("form", "root"), []
    while True:
        stepped = materialise(moving.join(onward, "root", "left").select("word", "root", "next"), "roots")
        ended.append(stepped.filter("next IS NULL").select("word", "root"))
        moving = stepped.filter("next IS NOT NULL").select("word", F.col("next").alias("root"))
        if moving.isEmpty():
            break
    roots = ended[0]
    for more in ended[1:]:
        roots = roots.unionByName(more)
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
