"""Token ids as canonical, length-limited Huffman code, in files of independent blocks.

Code lengths come from the counts of all ids by package-merge, at most ``LONGEST`` bits; codes
follow from the lengths. A file holds the documents of one range of doc_id in order:

    b"COVH1\\0\\0\\0", blocks, footer, offset of the footer (8 bytes), b"COVH1END"

Numbers are little-endian. A block is its number of ids, its number of 64-bit words and its
checkpoints (the bit at which every ``EVERY``-th id starts), all 32 bits wide, then the words, read
from their highest bit. The footer has the numbers of ids' kinds, documents and blocks, the code
length of every id (a byte each), the documents' doc_id, null marks and numbers of ids, and the
blocks' offsets. Blocks can be decoded on their own, and from any checkpoint on.
"""

from __future__ import annotations

import codecs
import functools
import json
import os
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covey.llm import columns, files
from covey.llm.bpe import id_lists
from covey.sources.shared import fresh_path, materialise

LONGEST = 20
BLOCK = 1 << 16
EVERY = 256
END_ID = 1
IDS_PER_FILE = 1 << 22
_HEAD, _TAIL = b"COVH1\0\0\0", b"COVH1END"
_WORDS_KEPT = 1 << 20
_LONG = 1 << 22

# The rules of a tokenizer file under which words can be encoded on their own.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
_SPLITTER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
# Letters that normal form C leaves as they are and lower case makes one letter each.
_LETTERS = re.compile(rb"(?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF]){1,64}")


def _byte_letters() -> str:
    """The character that stands for each byte in the pieces of a byte-level tokenizer."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return "".join(chr(b if b in shown else 256 + hidden.index(b)) for b in range(256))


_BYTE_LETTERS = _byte_letters()

# What a byte is to the borders of words.
_SPACE, _ALNUM, _MARK, _APOSTROPHE, _REST = range(5)


def _kinds() -> bytes:
    out = np.full(256, _REST, np.uint8)
    out[[9, 10, 11, 12, 13, 32]] = _SPACE
    out[0x21:0x7F] = _MARK
    out[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = _ALNUM
    out[0x27] = _APOSTROPHE
    return out.tobytes()


def _borders() -> bytes:
    """Of two bytes' kinds, at 8 times the first plus the second: whether there is a border between."""
    out = np.zeros((32, 8), bool)
    out[_SPACE] = out[_ALNUM, [_MARK, _APOSTROPHE]] = out[_MARK, _ALNUM] = True
    return out.tobytes()


_KIND, _BORDER = _kinds(), _borders()
_LATIN = np.zeros(256, bool)  # second byte of a letter whose first one is C3
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False


# --- code ----------------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Bits of each symbol's code, 0 for those that don't occur; the least total there is."""
    out = np.zeros(len(counts), np.uint8)
    present = np.flatnonzero(counts)
    n = len(present)
    if n < 2:
        out[present] = 1
        return out
    if n > 1 << longest:
        raise ValueError(f"{n} symbols don't fit codes of {longest} bits")
    order = present[np.argsort(counts[present], kind="stable")]
    weights = counts[order].astype(np.int64)
    merged, marks = weights, [np.ones(n, bool)]
    for _ in range(longest - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weights, pairs])
        sort = np.argsort(both, kind="stable")
        merged = both[sort]
        marks.append(sort < n)
    need = 2 * n - 2
    for mark in reversed(marks):
        leaves = int(mark[:need].sum())
        out[order[:leaves]] += 1
        need = 2 * (need - leaves)
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes in the order of length, then symbol."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    sizes = lengths[order].astype(np.int64)
    if len(order):
        # Each code's value at full width: the sum of the shares of those before it.
        share = np.left_shift(1, int(sizes.max()) - sizes)
        codes[order] = ((np.cumsum(share) - share) >> (int(sizes.max()) - sizes)).astype(np.uint64)
    return codes


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> bytes:
    """One block."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    at = ends - size
    word, shift = at >> 6, 64 - (at & 63) - size
    code = codes[ids]
    low = shift < 0
    high_part = np.where(low, code >> np.maximum(-shift, 0).astype(np.uint64), code << np.maximum(shift, 0).astype(np.uint64))
    words = np.zeros((int(ends[-1]) + 63 >> 6) + 1, np.uint64)
    head = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    words[word[head]] = np.add.reduceat(high_part, head)
    words[word[low] + 1] += code[low] << (64 + shift[low]).astype(np.uint64)
    marks = at[::EVERY].astype("<u4")
    return struct.pack("<II", len(ids), len(words)) + marks.tobytes() + words.astype("<u8").tobytes()


class Decoder:
    """Table-driven: the next ``longest`` bits give the symbol and its length."""

    def __init__(self, lengths: np.ndarray):
        self.bits = max(int(lengths.max()), 1) if len(lengths) else 1
        codes = canonical(lengths)
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        span = np.left_shift(1, self.bits - lengths[order].astype(np.int64))
        self.symbol = np.zeros(1 << self.bits, np.int32)
        self.length = np.zeros(1 << self.bits, np.int64)
        filled = int(span.sum())
        self.symbol[:filled] = np.repeat(order, span)
        self.length[:filled] = np.repeat(lengths[order].astype(np.int64), span)
        assert not len(order) or codes[order[0]] == 0

    def blocks(self, raw: list[bytes]) -> np.ndarray:
        """The ids of some blocks; all their stretches between checkpoints go side by side."""
        at, words, counts, base = [], [], [], 0
        for block in raw:
            n, size = struct.unpack_from("<II", block)
            marks = np.frombuffer(block, "<u4", -(-n // EVERY), 8)
            words.append(np.frombuffer(block, "<u8", size, 8 + 4 * len(marks)))
            at.append(marks.astype(np.int64) + 64 * base)
            counts.append(np.minimum(EVERY, n - EVERY * np.arange(len(marks))))
            base += size
        stream = np.append(np.concatenate(words), np.uint64(0))
        at, counts = np.concatenate(at), np.concatenate(counts)
        out = np.zeros((len(at), EVERY), np.int32)
        short = np.flatnonzero(counts < EVERY)
        for i in range(EVERY):
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            high = stream[word] << bit
            low = np.where(bit > 0, stream[np.minimum(word + 1, len(stream) - 1)] >> ((np.uint64(64) - bit) & np.uint64(63)), 0)
            next_ = ((high | low) >> np.uint64(64 - self.bits)).astype(np.int64)
            out[:, i] = self.symbol[next_]
            step = self.length[next_]
            step[short] *= counts[short] > i
            at = at + step
        keep = np.arange(EVERY) < counts[:, None]
        return out[keep]


# --- tokens --------------------------------------------------------------------------------


class WordTokenizer:
    """A tokenizer of the library that drops white space and lower-cases, applied to the words
    between borders that none of its rules looks past: they are encoded alike wherever they stand,
    and each only once while the table lasts.

    Such borders are ASCII white space, and where a letter or digit (of ASCII, or a letter of
    Latin-1) meets ASCII punctuation; not from an apostrophe to a letter, as in "'s". They are found
    in the bytes of many texts at once, Arrow tells a batch's words apart, and only its distinct
    words are looked up; a text's ids are gathered by their numbers.

    Words of Latin-1 letters are one piece that no rule changes but for the case, so they go to the
    library's model at once, past the rules that cost most. Of other words the library gets many in
    one text, which costs it less than many texts; as a word of letters is one piece, its number of
    the piece tells them apart.

    That rests on the file's rules. Texts with the string of a special token, which the library
    looks for before any rule, are given to it whole, as are all texts where the rules differ."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers

        self.library = tokenizers.Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self.by_words = rules["normalizer"] == _NORMALIZER and rules["pre_tokenizer"] == _SPLITTER
        self.specials = [token["content"] for token in rules["added_tokens"]]
        self.model = self.library.model
        self._forget()

    def _forget(self) -> None:
        self.words: dict[bytes, int] = {}  # a word's number
        self.ids = np.zeros(0, np.uint32)  # of all words in turn
        self.ends = np.zeros(1, np.int64)  # of a word's ids there, after a nought

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        whole = [not self.by_words or any(s in t for s in self.specials) for t in texts]
        self.library.encode_special_tokens = False
        given = self.library.encode_batch_fast([t for t, w in zip(texts, whole, strict=True) if w], add_special_tokens=False)
        # A word in lower case may read as a special token that its text doesn't hold.
        self.library.encode_special_tokens = True
        rest = iter(self._encode_by_words([t for t, w in zip(texts, whole, strict=True) if not w]))
        known = (np.array(g.ids, np.uint32) for g in given)
        return [next(known) if w else next(rest) for w in whole]

    def _encode_by_words(self, texts: list[str]) -> list[np.ndarray]:
        if all(len(t) <= _LONG for t in texts):
            return self._encode_batch(texts)
        return [np.concatenate([self._encode_batch([part])[0] for part in _parts(t)]) for t in texts]

    def _encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        words, first = _split(*columns.text_buffer(pa.array(texts, pa.large_string())))
        coded = words.dictionary_encode()
        kinds = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        number = np.fromiter(map(self.words.get, kinds, repeat(-1)), np.int64, len(kinds))
        if len(self.words) + int((number < 0).sum()) > _WORDS_KEPT:
            self._forget()
            number[:] = -1
        # Long words come last, and are not kept.
        new = [i for i in np.flatnonzero(number < 0).tolist() if len(kinds[i]) <= 64]
        kept, short = len(self.words), len(new)
        new += [i for i in np.flatnonzero(number < 0).tolist() if len(kinds[i]) > 64]
        number[new] = np.arange(kept, kept + len(new))
        ids, sizes = self._learn([kinds[i] for i in new])
        ids = np.concatenate([self.ids, ids])
        ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        self.words.update((kinds[i], n) for n, i in enumerate(new[:short], kept))
        self.ends = ends[: kept + short + 1]
        self.ids = ids[: self.ends[-1]]
        number = number[coded.indices.to_numpy()]
        start, size = ends[number], np.diff(ends)[number]
        until = np.append(0, np.cumsum(size))
        every = ids[np.arange(until[-1]) + np.repeat(start - until[:-1], size)]
        edges = until[first].tolist()
        return [every[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def _learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in turn, and each word's number of ids."""
        piece, letters, shown = self.model.tokenize, _LETTERS.fullmatch, codecs.charmap_decode
        rest = {w: _halves(w.decode()) for w in words if not (w.isalpha() and len(w) <= 64 or letters(w))}
        known = self._by_rules({x for halves in rest.values() for x in halves})
        ids, sizes = [], []
        for w in words:
            if w in rest:
                got = [i for x in rest[w] for i in known[x]]
            else:
                lower = w.lower() if w.isascii() else w.decode().lower().encode()
                got = [token.id for token in piece(shown(lower, "strict", _BYTE_LETTERS)[0])]
            ids += got
            sizes.append(len(got))
        return np.array(ids, np.uint32), np.array(sizes, np.int64)

    def _by_rules(self, words: set[str]) -> dict[str, list[int]]:
        known = {}
        plain = sorted(w for w in words if w.isalpha() and len(w) <= 64)
        groups = [plain[i : i + 64] for i in range(0, len(plain), 64)]
        other = [w for w in words if not (w.isalpha() and len(w) <= 64)]
        for i in range(0, len(groups), 256):
            some = groups[i : i + 256]
            joined = self.library.encode_batch_fast([" ".join(g) for g in some], add_special_tokens=False)
            for group, got in zip(some, joined, strict=True):
                number = np.array(got.word_ids, dtype=float)
                cut = np.flatnonzero(np.append(True, number[1:] != number[:-1])).tolist()
                if len(cut) != len(group) or np.isnan(number).any():
                    other += group  # some word isn't one piece
                    continue
                ids = got.ids
                known.update((w, ids[a:b]) for w, a, b in zip(group, cut, [*cut[1:], len(ids)], strict=True))
        for i in range(0, len(other), 1 << 14):
            some = other[i : i + (1 << 14)]
            got = self.library.encode_batch_fast(some, add_special_tokens=False)
            known.update((w, g.ids) for w, g in zip(some, got, strict=True))
        return known


def _halves(stretch: str) -> tuple[str, str]:
    """A stretch's word and closing punctuation."""
    word = stretch.rstrip(".,!?;:*#%&$")
    # A lone mark, also one that normal form C parts from its letter, would join the punctuation.
    if not word or unicodedata.category(unicodedata.normalize("NFC", word)[-1].lower()[-1])[0] not in "LN":
        return stretch, ""
    return word, stretch[len(word) :]


def _parts(text: str) -> Iterator[str]:
    """A long text in parts that end at a space."""
    a = 0
    while 0 <= (b := text.find(" ", a + _LONG)):
        yield text[a:b]
        a = b
    yield text[a:]


def _split(data: np.ndarray, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words between the borders, ASCII in lower case but before what may be a combining mark,
    and of each text the number of words before it; n+1 long."""
    data = data.copy()
    data[:-1] += ((data[:-1] - 65 < 26) & (data[1:] < 0xC4)).view(np.uint8) << 5
    kind = np.frombuffer(bytearray(data.tobytes().translate(_KIND)), np.uint8)
    high = np.flatnonzero(data[:-1] == 0xC3)
    high = high[_LATIN[data[high + 1]]]
    kind[high] = kind[high + 1] = _ALNUM
    inside = kind != _SPACE
    begin = np.ones(len(kind), bool)
    begin[1:] = np.frombuffer((kind[:-1] << 3 | kind[1:]).tobytes().translate(_BORDER), bool)
    begin[at[:-1][at[:-1] < len(kind)]] = True
    end = np.append(begin[1:] | ~inside[1:], True)[: len(kind)] & inside
    starts = np.flatnonzero(begin & inside)
    offsets = np.append(0, np.cumsum(np.flatnonzero(end) + 1 - starts))
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
    )
    return words, np.searchsorted(starts, at)


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def tokens(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """``doc_id, packed``: each text's ids and the end id, 32 bits wide and compressed."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, words = zstandard.ZstdCompressor(level=3), tokenizer(path)
        for part in columns.texts(batches, "text", 1 << 22):
            out = []
            for ids in words.encode([t or "" for t in part.column(1).to_pylist()]):
                out.append(press.compress(_planes(np.append(ids, np.uint32(end_id)))))
            yield pa.record_batch([part.column(0), pa.array(out, pa.binary())], ["doc_id", "packed"])

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, packed binary")


def _planes(ids: np.ndarray) -> bytes:
    """The low halves of all ids, then the high halves, which are mostly nought."""
    return np.concatenate([ids & 0xFFFF, ids >> 16]).astype("<u2").tobytes()


def _unpack(data: bytes) -> np.ndarray:
    halves = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<u2").astype(np.int64)
    return halves[: len(halves) // 2] | halves[len(halves) // 2 :] << 16


def _added(total: np.ndarray, ids: list[np.ndarray]) -> np.ndarray:
    """The counts with those of some more ids."""
    got = np.bincount(np.concatenate([np.zeros(0, np.int64), *ids]), minlength=len(total))
    got[: len(total)] += total
    return got


def _counts(coded: DataFrame) -> np.ndarray:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = np.zeros(0, np.int64), [], 0
        for batch in batches:
            for data in batch.column(0).to_pylist():
                held.append(_unpack(data))
                size += len(held[-1])
                if size > 1 << 20:
                    total, held, size = _added(total, held), [], 0
        total = _added(total, held)
        ids = np.flatnonzero(total)
        yield pa.record_batch({"id": ids, "n": total[ids]})

    rows = coded.select("packed").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return counts


# --- files ---------------------------------------------------------------------------------


def write(docs: DataFrame, path: str, folder: str, end_id: int = END_ID, ids_per_file: int = IDS_PER_FILE) -> DataFrame:
    """Encode every text and write the files in ascending doc_id order (null first; rows of one
    doc_id in the order of their ids). The manifest ``part, uri, n_docs, n_ids`` lists them in
    order. A null or empty text is its end id alone; of an empty table there is no file."""
    coded = materialise(tokens(docs, path, end_id), "huffman-tokens")
    counts = _counts(coded)
    spark = docs.sparkSession
    lengths = spark.sparkContext.broadcast(code_lengths(counts))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, writer = TaskContext.get().partitionId(), None
        for batch in batches:
            for doc_id, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                writer = writer or _Writer(folder, f"ids-{part:06d}", lengths.value)
                writer.add(doc_id, _unpack(data))
        if writer:
            yield pa.record_batch({"part": [part], "uri": [writer.close()], "n_docs": [len(writer.docs)], "n_ids": [writer.n_ids]})

    n_files = max(1, -(-int(counts.sum()) // ids_per_file))
    manifest = (
        coded.repartitionByRange(n_files, F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "packed")
        .mapInArrow(put, "part long, uri string, n_docs long, n_ids long")
    )
    return materialise(manifest, "huffman-manifest")


class _Writer:
    def __init__(self, folder: str, name: str, lengths: np.ndarray):
        self.uri, self.out = files.create(folder, name)
        self.lengths, self.codes = lengths, canonical(lengths)
        self.docs: list[tuple[int | None, int]] = []
        self.offsets: list[int] = []
        self.n_ids, self.held, self.rows = 0, [], 0
        self.out.write(_HEAD)
        self.at = len(_HEAD)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.n_ids += len(ids)
        self.held.append(ids)
        self.rows += len(ids)
        if self.rows >= BLOCK:
            every = np.concatenate(self.held)
            full = len(every) // BLOCK * BLOCK
            for i in range(0, full, BLOCK):
                self._block(every[i : i + BLOCK])
            self.held, self.rows = [every[full:]], len(every) - full

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.codes, self.lengths)
        self.offsets.append(self.at)
        self.out.write(data)
        self.at += len(data)

    def close(self) -> str:
        if self.rows:
            self._block(np.concatenate(self.held))
        names = np.array([d or 0 for d, _ in self.docs], "<i8")
        nulls = np.array([d is None for d, _ in self.docs], np.uint8)
        sizes = np.array([n for _, n in self.docs], "<u8")
        self.out.write(struct.pack("<QQQ", len(self.lengths), len(self.docs), len(self.offsets)))
        for part in (self.lengths, names, nulls, sizes, np.array([*self.offsets, self.at], "<u8")):
            self.out.write(part.tobytes())
        self.out.write(struct.pack("<Q", self.at) + _TAIL)
        self.out.close()
        return self.uri


def read_file(uri: str, together: int = 16) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """``doc_id, start, ids`` of a file's documents, its blocks decoded some at a time."""
    with files.open_random(uri) as source:
        size = source.size()
        at, tail = struct.unpack("<Q8s", source.read_at(16, size - 16))
        if tail != _TAIL or source.read_at(8, 0) != _HEAD:
            raise ValueError(f"{uri} is not a file of ids")
        footer = source.read_at(size - 16 - at, at)
        kinds, n, n_blocks = struct.unpack_from("<QQQ", footer)
        spots = np.cumsum([24, kinds, 8 * n, n, 8 * n])
        lengths = np.frombuffer(footer, np.uint8, kinds, int(spots[0]))
        names = np.frombuffer(footer, "<i8", n, int(spots[1]))
        nulls = np.frombuffer(footer, np.uint8, n, int(spots[2]))
        sizes = np.frombuffer(footer, "<u8", n, int(spots[3])).astype(np.int64)
        offsets = np.frombuffer(footer, "<u8", n_blocks + 1, int(spots[4])).astype(np.int64)
        decoder, held, doc, start = Decoder(lengths), np.zeros(0, np.int32), 0, 0
        for i in range(0, n_blocks, together):
            j = min(i + together, n_blocks)
            raw = source.read_at(int(offsets[j] - offsets[i]), int(offsets[i]))
            parts = [raw[offsets[k] - offsets[i] : offsets[k + 1] - offsets[i]] for k in range(i, j)]
            held = np.concatenate([held, decoder.blocks(parts)])
            used = 0
            while doc < n and used + sizes[doc] <= len(held):
                yield (None if nulls[doc] else int(names[doc])), start, held[used : used + sizes[doc]]
                used += int(sizes[doc])
                start += int(sizes[doc])
                doc += 1
            held = held[used:]


def read(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and ``ids`` of every document in the files;
    ``start`` counts the ids of all documents before it. The driver sees a row per file."""
    spark = manifest.sparkSession
    rows = sorted(manifest.select("part", "n_ids").collect())
    bases, total = {}, 0
    for part, n in rows:
        bases[part] = total
        total += n

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, uri in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held, size = [], 0
                for doc_id, start, ids in read_file(uri):
                    held.append((doc_id, bases[part] + start, ids))
                    size += len(ids)
                    if size > 1 << 20 or len(held) >= 1 << 12:
                        yield rows_of(held)
                        held, size = [], 0
                if held:
                    yield rows_of(held)

    def rows_of(held: list) -> pa.RecordBatch:
        out = {
            "doc_id": pa.array([h[0] for h in held], pa.int64()),
            "start": pa.array([h[1] for h in held], pa.int64()),
            "n_tokens": pa.array([len(h[2]) for h in held], pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(h[2].astype("<u4").tobytes()) for h in held], pa.int64()),
        }
        if with_ids:
            out["ids"] = id_lists([h[2] for h in held])
        return pa.record_batch(out)

    kind = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    spread = manifest.select("part", "uri").repartition(max(1, len(rows)), "part")
    return spread.mapInArrow(get, kind)


def folder(spark) -> str:
    return fresh_path(spark, "huffman")
