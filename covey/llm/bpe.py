"""Byte-level BPE, encoding and decoding, as a monoid reduced over a tree.

An element of the monoid is a stretch of text with its tokens. Texts are halved anywhere down to
leaves, leaves are encoded, and neighbours are joined, level by level, by encoding anew only a
window at their border. Two facts make the joins exact:

* *Between pieces.* The split pattern looks only to the right, and at most one character far. If
  the characters on both sides of a place are of different classes (letter, number, white space,
  other), the left one is not white space, and it is not an apostrophe before a letter, then a
  piece ends at the place whatever stands around it. So the window at a border grows on both sides
  until it reaches such a place, or the end of the stretch: the tokens beyond are those of whole
  pieces that the border cannot change, and are kept.
* *Inside a piece.* Merging takes the lowest rank first, the leftmost of equals. A sequence of
  tokens is the encoding of its bytes if and only if each two neighbours are the encoding of
  theirs: as long as no merge has crossed a token's edge, the merges within two neighbours are
  those of the two alone, so the first merge across an edge would also happen in the pair alone;
  and the other way round, two neighbours of an encoding never merged across their edge. So a
  window is wide enough once its outermost tokens come out unchanged: all neighbours outside and
  inside are then valid pairs, and tokens beyond the window cannot change. Until then the window
  doubles.

Pieces are joined this way only when longer than a leaf. Leaves not seen before are merged many at
a time, and a table bounded in bytes keeps the ids of short pieces. A worker process holds one
encoder; ids are decoded where they are made, and the ids of texts in several segments by a decoder
that holds the tokens only.
"""

from __future__ import annotations

import base64
import functools
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covey.llm.columns import text_buffer

SEGMENT_CHARS = 1 << 16
_LEAF_CHARS = 1 << 11
_LEAF_IDS = 1 << 13
_LEAF_BYTES = 48
_KEPT_BYTES = 48 << 20
_ENTRY_BYTES = 200  # of the table, besides a piece's own characters and ids
_CLASS = regex.compile(r"(\p{L})|(\p{N})|(\s)|(.)", regex.DOTALL)


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Decoder:
    """The tokens of a vocabulary file by id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids: leaves are looked up, and neighbours concatenated up the tree."""
        look = self.tokens.__getitem__
        level = [
            b"".join(map(look, ids[i : i + _LEAF_IDS].tolist())) for i in range(0, len(ids), _LEAF_IDS)
        ]
        while len(level) > 1:
            level = [b"".join(level[i : i + 2]) for i in range(0, len(level), 2)]
        return level[0] if level else b""


class _Pieces(dict):
    """Ids of pieces as bytes of 32-bit numbers; of a batch's long pieces beside them."""

    long: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        return self.long[piece]


class ByteBpe(Decoder):
    """Encoder and decoder over the ranks of a vocabulary file."""

    def __init__(self, path: str, pattern: str):
        self.ranks = _ranks(path)
        super().__init__(self.ranks)
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.pieces = regex.compile(pattern).findall
        self.seen, self.seen_bytes = _Pieces(), 0
        self.joins = 0
        self._pair_table()

    def _pair_table(self) -> None:
        """Hash table from two ids to the id of both together, for whole arrays of pairs."""
        get = self.ranks.get
        found = (
            number
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
            for number in (get(token[:i]) << 32 | get(token[i:]), rank)
        )
        keys, values = np.fromiter(found, np.int64).reshape(-1, 2).T
        size = min(1 << 24, 1 << (4 * len(keys)).bit_length())
        self.none = len(self.tokens)
        self._keys, self._values = np.full(size, -1), np.full(size, self.none, np.int32)
        slot = self._slot(keys)
        while len(keys):
            # One key may take a free slot; the others go on to the next.
            free = np.flatnonzero(self._keys[slot] == -1)
            _, one = np.unique(slot[free], return_index=True)
            took = free[one]
            self._keys[slot[took]], self._values[slot[took]] = keys[took], values[took]
            rest = np.ones(len(keys), bool)
            rest[took] = False
            keys, values, slot = keys[rest], values[rest], (slot[rest] + 1) & (size - 1)
        self._byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(40)).astype(np.int64) & (len(self._keys) - 1)

    def _joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        out = np.full(len(keys), self.none, np.int32)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            there = self._keys[slot]
            hit = there == keys[todo]
            out[todo[hit]] = self._values[slot[hit]]
            on = ~hit & (there != -1)
            todo, slot = todo[on], (slot[on] + 1) & (len(self._keys) - 1)
        return out

    # --- pieces ---------------------------------------------------------------------------

    def _merge(self, data: bytes) -> list[int]:
        """The tokens of a short stretch, by merging."""
        get, none = self.ranks.get, len(self.tokens)
        at = list(range(len(data) + 1))  # edges of the parts
        ranks = [get(data[i : i + 2], none) for i in range(len(data) - 1)]  # of neighbours joined
        while ranks and (best := min(ranks)) < none:
            i = ranks.index(best)
            del at[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get(data[at[i] : at[i + 2]], none)
            if i:
                ranks[i - 1] = get(data[at[i - 1] : at[i + 1]], none)
        return [get(data[i:j]) for i, j in zip(at, at[1:])]

    def _merge_many(self, group: list[bytes]) -> list[tuple[int, ...]]:
        """The same for many stretches of one length at once: a row each."""
        width, none = len(group[0]), self.none
        if width == 1:
            return [(self.ranks[g],) for g in group]
        ids = self._byte[np.frombuffer(b"".join(group), np.uint8).reshape(-1, width)]
        ranks = self._joined(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(-1, width - 1)
        rows, out = np.arange(len(group)), [()] * len(group)
        while True:
            if width == 1:
                for row, got in zip(rows.tolist(), ids.tolist(), strict=True):
                    out[row] = tuple(got)
                return out
            best = ranks.argmin(1)
            low = ranks[np.arange(len(ids)), best]
            for row, got in zip(rows[low == none].tolist(), ids[low == none].tolist(), strict=True):
                out[row] = tuple(got)
            on = low < none
            if not on.any():
                return out
            rows, ids, ranks, best, low = rows[on], ids[on], ranks[on], best[on], low[on]
            every, width = np.arange(len(ids)), width - 1
            ids = np.where(np.arange(width) > best[:, None], ids[:, 1:], ids[:, :-1])
            ids[every, best] = low
            if width > 1:
                ranks = np.where(np.arange(width - 1) >= best[:, None], ranks[:, 1:], ranks[:, :-1])
                a = np.flatnonzero(best < width - 1)
                ranks[a, best[a]] = self._joined(ids[a, best[a]], ids[a, best[a] + 1])
                b = np.flatnonzero(best > 0)
                ranks[b, best[b] - 1] = self._joined(ids[b, best[b] - 1], ids[b, best[b]])

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The tokens of two neighbouring stretches of one piece, from the tokens of each."""
        if not left or not right:
            return left or right
        width = 1
        while True:
            a, b = min(width, len(left)), min(width, len(right))
            window = left[len(left) - a :] + right[:b]
            if a == len(left) and b == len(right) or self._bytes(window) <= 4 * _LEAF_BYTES:
                middle = self._merge(b"".join(map(self.tokens.__getitem__, window)))
            else:
                # Not yet stable and no longer short: the window itself is reduced as a tree.
                middle = self._tree(b"".join(map(self.tokens.__getitem__, window)))
            if (a == len(left) or middle[0] == window[0]) and (
                b == len(right) or middle[-1] == window[-1]
            ):
                return left[: len(left) - a] + middle + right[b:]
            width *= 2

    def _bytes(self, ids: list[int]) -> int:
        return sum(len(self.tokens[i]) for i in ids)

    def _tree(self, data: bytes) -> list[int]:
        if len(data) <= _LEAF_BYTES:
            return self._merge(data)
        level = [
            self._merge(data[i : i + _LEAF_BYTES]) for i in range(0, len(data), _LEAF_BYTES)
        ]
        while len(level) > 1:
            level = [
                self.join(level[i], level[i + 1]) if i + 1 < len(level) else level[i]
                for i in range(0, len(level), 2)
            ]
        return level[0]

    def _learn(self, pieces: set[str]) -> None:
        """Ids of pieces into the table; the long ones only until the next batch."""
        if self.seen_bytes > _KEPT_BYTES:
            self.seen.clear()
            self.seen_bytes = 0
        by_length: dict[int, list[str]] = {}
        self.seen.long = {}
        for p in pieces - self.seen.keys():
            n = len(p.encode())
            if n <= _LEAF_BYTES:
                by_length.setdefault(n, []).append(p)
                self.seen_bytes += _ENTRY_BYTES + 2 * n
            else:
                self.seen.long[p] = _packed(self._tree(p.encode()))
        for group in by_length.values():
            if len(group) < 8:
                self.seen.update((p, _packed(self._merge(p.encode()))) for p in group)
            else:
                many = self._merge_many([p.encode() for p in group])
                self.seen.update((p, _packed(ids)) for p, ids in zip(group, many, strict=True))

    # --- texts ----------------------------------------------------------------------------

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of whole texts: leaves of all texts first, then all joins of a level."""
        levels = [_edges(len(t), _LEAF_CHARS) for t in texts]
        leaves_ = [t[a:b] for t, edges in zip(texts, levels, strict=True) for a, b in zip(edges, edges[1:])]
        ids = iter(self._pieces_of(leaves_))
        rows = [[next(ids) for _ in edges[1:]] for edges in levels]
        while any(len(row) > 1 for row in rows):
            joins = [
                (n, i, *_window(texts[n], edges[i], edges[i + 1], edges[i + 2]))
                for n, edges in enumerate(levels)
                for i in range(0, len(edges) - 2, 2)
            ]
            anew = iter(self._pieces_of([texts[n][a:b] for n, _, a, b in joins]))
            joined: dict[tuple[int, int], np.ndarray] = {}
            for n, i, a, b in joins:
                middle = levels[n][i + 1]
                left, right = texts[n][a:middle], texts[n][middle:b]
                kept = rows[n][i][: len(rows[n][i]) - self._covering(rows[n][i][::-1], left)]
                rest = rows[n][i + 1][self._covering(rows[n][i + 1], right) :]
                joined[n, i] = np.concatenate([kept, next(anew), rest])
            self.joins += len(joins)
            rows = [
                [joined.get((n, i), row[i]) for i in range(0, len(row), 2)] if len(row) > 1 else row
                for n, row in enumerate(rows)
            ]
            levels = [e if len(e) == 2 else e[:-1:2] + e[-1:] for e in levels]
        return [row[0] for row in rows]

    def _pieces_of(self, stretches: list[str]) -> list[np.ndarray]:
        """The ids of stretches, each split into pieces on its own."""
        split = [self.pieces(s) for s in stretches]
        self._learn(set().union(*split))
        look = self.seen.__getitem__
        return [np.frombuffer(b"".join(map(look, pieces)), np.int32) for pieces in split]

    def _covering(self, ids: np.ndarray, text: str) -> int:
        """How many of the ids, from the first on, are those of ``text``: it ends where pieces do."""
        size = len(text.encode())
        if not size:
            return 0
        some = ids[:size]
        return int(np.searchsorted(np.cumsum(self.lengths[some]), size)) + 1

    def encode(self, text: str) -> np.ndarray:
        return self.encode_many([text])[0]


def _packed(ids: Sequence[int]) -> bytes:
    return array("i", ids).tobytes()


def _edges(size: int, most: int) -> list[int]:
    """Where halving a text, and its halves again, cuts it: both ends too."""
    parts = 1
    while size > most * parts:
        parts *= 2
    return [size * i // parts for i in range(parts + 1)]


def _window(text: str, start: int, middle: int, end: int) -> tuple[int, int]:
    """The nearest places about ``middle`` where a piece ends for certain, or the ends."""
    a = middle - 1
    while a > start and not _safe(text, a):
        a -= 1
    b = middle + 1
    while b < end and not _safe(text, b):
        b += 1
    return max(a, start), min(b, end)


def leaves(text: str, most: int) -> list[str]:
    """``text`` halved until no part is longer than ``most`` characters, each cut moved to the
    nearest place where a piece ends for certain. A run without such a place stays whole."""
    if len(text) <= most:
        return [text]
    cut = _safe_cut(text, len(text) // 2)
    if cut is None:
        return [text]
    return leaves(text[:cut], most) + leaves(text[cut:], most)


def _kind(char: str) -> int:
    return _CLASS.match(char).lastindex


def _safe(text: str, i: int) -> bool:
    a, b = _kind(text[i - 1]), _kind(text[i])
    return a != b and a != 3 and not (text[i - 1] == "'" and b == 1)


def _safe_cut(text: str, middle: int) -> int | None:
    for off in range(max(middle, len(text) - middle)):
        if 0 < middle - off and _safe(text, middle - off):
            return middle - off
        if middle + off < len(text) and _safe(text, middle + off):
            return middle + off
    return None


@functools.lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> ByteBpe:
    """One table per worker process, kept from task to task."""
    return ByteBpe(path, pattern)


@functools.lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(_ranks(path))


def encode(docs: DataFrame, path: str, pattern: str, segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """``doc_id, ids array<int>`` of every text; a null text is empty, an empty one has no ids.

    Texts up to ``segment_chars`` are encoded where they are read, without a shuffle. Longer ones
    are first halved into segments, which are spread over the tasks and encoded on their own; a
    document's segments then meet in order and their ids are concatenated. Rows are treated one
    by one: repeated rows and repeated or null ``doc_id`` give a row each.
    """
    short, long = _encoded(docs, path, pattern, segment_chars, decoded=False)
    return short.unionByName(long)


def _encoded(
    docs: DataFrame, path: str, pattern: str, segment_chars: int, decoded: bool
) -> tuple[DataFrame, DataFrame]:
    """The encoded texts of one segment, with ``decoded`` the bytes of their ids too, and those of
    several segments."""
    texts = docs.select("doc_id", "text")
    short = texts.filter(F.coalesce(F.length("text"), F.lit(0)) <= segment_chars)
    long = texts.filter(F.length("text") > segment_chars)
    schema = "doc_id long, ids array<int>" + (", decoded binary" if decoded else "")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path, pattern)
        for batch in batches:
            for part in _slices(batch):
                got = bpe.encode_many([t or "" for t in part.column(1).to_pylist()])
                out = {"doc_id": part.column(0), "ids": id_lists(got)}
                if decoded:
                    out["decoded"] = pa.array([bpe.decode(ids) for ids in got], pa.binary())
                yield pa.record_batch(out)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts = leaves(text, segment_chars)
                for i in range(0, len(parts), 64):
                    some = parts[i : i + 64]
                    yield pa.record_batch(
                        {
                            "doc_id": pa.array([doc_id] * len(some), pa.int64()),
                            "row": pa.array([key] * len(some), pa.string()),
                            "part": pa.array(range(i, i + len(some)), pa.int32()),
                            "text": pa.array(some, pa.string()),
                        }
                    )

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path, pattern)
        for batch in batches:
            for some in _cut(batch, text_buffer(batch.column("text"))[1], 1 << 20):
                got = bpe.encode_many(some.column("text").to_pylist())
                yield pa.record_batch(
                    [*some.columns[:3], id_lists(got)], ["doc_id", "row", "part", "ids"]
                )

    # One row stands for itself: the copy of a row gets its own key.
    keyed = long.select(
        "doc_id",
        F.concat_ws(":", F.xxhash64("text").cast("string"), F.monotonically_increasing_id().cast("string")).alias("row"),
        "text",
    )
    segments = keyed.mapInArrow(split, "doc_id long, row string, part int, text string")
    encoded = segments.repartition("row", "part").mapInArrow(
        parts, "doc_id long, row string, part int, ids array<int>"
    )
    joined = (
        encoded.groupBy("doc_id", "row")
        .agg(F.sort_array(F.collect_list(F.struct("part", "ids"))).alias("parts"))
        .select("doc_id", F.flatten("parts.ids").alias("ids"))
    )
    return short.mapInArrow(whole, schema), joined


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, decoded binary``: the bytes of each list of ids (null: none)."""

    def bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = decoder(path)
        for batch in batches:
            for part in _id_slices(batch):
                ids = part.column(1)
                out = [
                    tokens.decode(i.values.to_numpy(zero_copy_only=False)) if i.is_valid else b""
                    for i in ids
                ]
                yield pa.record_batch(
                    [part.column(0), ids, pa.array(out, pa.binary())], ["doc_id", "ids", "decoded"]
                )

    return encoded.select("doc_id", "ids").mapInArrow(
        bytes_of, "doc_id long, ids array<int>, decoded binary"
    )


def encode_decode(
    docs: DataFrame, path: str, pattern: str, segment_chars: int = SEGMENT_CHARS
) -> DataFrame:
    """``doc_id, ids, decoded``: the ids of each text, and the bytes that these ids stand for."""
    short, long = _encoded(docs, path, pattern, segment_chars, decoded=True)
    return short.unionByName(decode(long, path))


def with_digests(coded: DataFrame) -> DataFrame:
    """``doc_id, ids`` with the number of ids and the SHA-256 of the ids and of the bytes."""
    return coded.select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def id_lists(lists: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(lists) + 1, np.int32)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    values = np.concatenate(lists) if lists else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def _slices(batch: pa.RecordBatch, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    yield from _cut(batch, text_buffer(batch.column(1))[1], most)


def _id_slices(batch: pa.RecordBatch, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    yield from _cut(batch, batch.column(1).offsets.to_numpy().astype(np.int64), most)


def _cut(batch: pa.RecordBatch, at: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(at, at[a] + most, "right")) - 1)
        yield batch.slice(a, b - a)
        a = b
