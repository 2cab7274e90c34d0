"""Language of a text by a convolutional network over bytes.

Bytes are embedded; filters two, three and four bytes wide run over windows of fixed length; the
largest answer of each filter in a window goes through a softmax layer. A text's windows overlap
by the widest filter less one byte, so every stretch of the whole text is seen once, and its
languages' probabilities are averaged over its windows, weighted by their bytes.

The network is trained in numpy on a bounded sample: the ``sample_per_language`` (about; at most
half as many again) labelled documents with the smallest hashes of each of the
``most_languages`` most frequent languages, four windows of each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covey.llm.columns import text_buffer

UNDECIDED = "und"
WINDOW = 256
WIDTHS = {2: 8, 3: 12, 4: 12}  # filters of each width
_WIDEST = max(WIDTHS)
_EMBED = 8
_PAD = 256


@dataclass
class Network:
    languages: list[str]
    embed: np.ndarray  # 257 x _EMBED; the last row, the padding's, is zero
    filters: np.ndarray  # _WIDEST * _EMBED x filters; zero where a filter is narrower
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray

    def features(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Largest answers, where they are, and the stretches under the filters."""
        seen = self.embed[windows]
        n, length, _ = seen.shape
        stretch = np.lib.stride_tricks.as_strided(
            seen,
            (n, length - _WIDEST + 1, _WIDEST * _EMBED),
            (seen.strides[0], seen.strides[1], seen.strides[2]),
        )
        answers = (np.ascontiguousarray(stretch).reshape(-1, _WIDEST * _EMBED) @ self.filters).reshape(
            n, length - _WIDEST + 1, -1
        )
        return answers, stretch, seen

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.languages)), np.float32)
        for i in range(0, len(windows), 512):
            top = np.maximum(self.features(windows[i : i + 512])[0].max(1) + self.bias, 0)
            out[i : i + 512] = _softmax(top @ self.dense + self.offset)
        return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], steps: int = 500, batch: int = 96) -> Network:
    """Fit by Adam on cross entropy; the same input gives the same network."""
    pick, count = np.random.default_rng(7), sum(WIDTHS.values())
    mask = np.zeros((_WIDEST * _EMBED, count), np.float32)
    at = 0
    for width, n in WIDTHS.items():
        mask[: width * _EMBED, at : at + n] = 1
        at += n
    net = Network(
        languages,
        pick.normal(0, 0.5, (257, _EMBED)).astype(np.float32),
        pick.normal(0, 0.3, mask.shape).astype(np.float32) * mask,
        np.zeros(count, np.float32),
        pick.normal(0, 0.3, (count, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    net.embed[_PAD] = 0
    params = [net.embed, net.filters, net.bias, net.dense, net.offset]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, steps + 1):
        rows = pick.integers(0, len(windows), batch)
        grads = _gradients(net, windows[rows], labels[rows], mask)
        for p, g, (m, v) in zip(params, grads, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        net.embed[_PAD] = 0
    return net


def _gradients(net: Network, windows: np.ndarray, labels: np.ndarray, mask: np.ndarray) -> list[np.ndarray]:
    answers, stretch, _ = net.features(windows)
    place = answers.argmax(1)  # window x filter
    raw = np.take_along_axis(answers, place[:, None], 1)[:, 0] + net.bias
    top = np.maximum(raw, 0)
    miss = _softmax(top @ net.dense + net.offset)
    miss[np.arange(len(labels)), labels] -= 1
    miss /= len(labels)
    back = (miss @ net.dense.T) * (raw > 0)
    under = stretch[np.arange(len(windows))[:, None], place]  # window x filter x bytes' embeddings
    d_filters = np.einsum("nf,nfe->ef", back, under) * mask
    d_under = (back[:, :, None] * net.filters.T[None]).reshape(-1, _EMBED)
    bytes_under = windows[np.arange(len(windows))[:, None, None], place[:, :, None] + np.arange(_WIDEST)]
    d_embed = np.zeros_like(net.embed)
    np.add.at(d_embed, bytes_under.reshape(-1), d_under)
    return [d_embed, d_filters, back.sum(0), top.T @ miss, miss.sum(0)]


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows over whole texts, the text of each, and its bytes; short ones are padded."""
    sizes = np.diff(offsets)
    step = WINDOW - _WIDEST + 1
    each = np.maximum(1, -(-(sizes - _WIDEST + 1) // step)) * (sizes > 0)
    owner = np.repeat(np.arange(len(sizes)), each)
    first = np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)
    start = offsets[owner] + first * step
    length = np.minimum(WINDOW, offsets[owner + 1] - start)
    at = start[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < length[:, None]
    out = np.where(inside, data[np.minimum(at, max(len(data) - 1, 0))] if len(data) else 0, _PAD)
    return out.astype(np.int16), owner, length


def _in_training(doc_id: str = "doc_id") -> F.Column:
    return F.crc32(F.col(doc_id).cast("string")) % 4 != 2


def fit(docs: DataFrame, sample_per_language: int = 600, most_languages: int = 256) -> Network | None:
    """The network learned from the labelled rows that are not held out; None without any."""
    labelled = docs.select("doc_id", "text", "lang").filter(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & _in_training()
    )
    counts = (
        labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages).collect()
    )
    if not counts:
        return None
    # A share of a hash's range, so the sample is spread over the table and needs no sort.
    share = F.create_map(
        *[F.lit(x) for r in counts for x in (r["lang"], min(1.0, 1.25 * sample_per_language / r["count"]))]
    )
    sample = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text, doc in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = np.frombuffer(text.encode(), np.uint8)
                for part in range(4):
                    # Four places spread over the text; a short text gives one window.
                    at = (len(data) - WINDOW) * part // 3 if len(data) > WINDOW else 0
                    if len(data) and (part == 0 or len(data) > WINDOW):
                        yield pa.record_batch(
                            {"lang": [lang], "doc_id": pa.array([doc], pa.int64()), "part": pa.array([part], pa.int32()), "bytes": pa.array([data[at : at + WINDOW].tobytes()], pa.binary())}
                        )

    got = sample.select("lang", "text", "doc_id").mapInArrow(
        cut, "lang string, doc_id long, part int, bytes binary"
    )
    rows = sorted(map(tuple, got.collect()), key=lambda r: (r[0], zlib.crc32(str(r[1]).encode()), *r[1:]))
    languages = sorted({r[0] for r in rows})
    kept: list[tuple] = []
    for lang in languages:
        kept += [r for r in rows if r[0] == lang][: 6 * sample_per_language]
    if not kept:
        return None
    data = np.frombuffer(b"".join(r[3] for r in kept), np.uint8)
    offsets = np.cumsum([0] + [len(r[3]) for r in kept])
    windows, owner, _ = windows_of(data, offsets)
    labels = np.array([languages.index(r[0]) for r in kept])
    # Every language counts alike, however many labelled windows it has.
    places = [np.flatnonzero(labels == i) for i in range(len(languages))]
    most = max(map(len, places))
    even = np.concatenate([np.resize(p, most) for p in places])
    return train(windows[owner.argsort(kind="stable")][even], labels[even], languages)


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``lang_score`` added.

    A text that is null or has no letter is ``und`` with score 0, as is every text if nothing was
    learned. Every row is kept, repeated ones too. Columns of these two names are replaced.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                names, scores = _predict(part.column("text"), net)
                yield pa.record_batch(
                    [*part.columns, names, scores], schema=part.schema.append(pa.field("lang_pred", pa.string())).append(pa.field("lang_score", pa.float64()))
                )

    plain = docs.drop("lang_pred", "lang_score")
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in plain.schema)
    return plain.mapInArrow(apply, f"{fields}, lang_pred string, lang_score double")


def _parts(batch: pa.RecordBatch, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    at = text_buffer(batch.column("text"))[1]
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(at, at[a] + most, "right")) - 1)
        yield batch.slice(a, b - a)
        a = b


def _predict(texts: pa.Array, net: Network | None) -> tuple[pa.Array, pa.Array]:
    n = len(texts)
    letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
    if net is None or not letters.any():
        return pa.array([UNDECIDED] * n), pa.array(np.zeros(n))
    data, offsets = text_buffer(texts)
    sums, weights = np.zeros((n, len(net.languages))), np.zeros(n)
    windows, owner, length = windows_of(data, offsets)
    for a in range(0, len(windows), 4096):
        got = net.probabilities(windows[a : a + 4096]) * length[a : a + 4096, None]
        np.add.at(sums, owner[a : a + 4096], got)
    np.add.at(weights, owner, length)
    share = sums / np.maximum(weights, 1)[:, None]
    best = share.argmax(1)
    score = np.where(letters, np.clip(share[np.arange(n), best], 0, 1), 0)
    names = [net.languages[b] if ok else UNDECIDED for b, ok in zip(best.tolist(), letters.tolist(), strict=True)]
    return pa.array(names, pa.string()), pa.array(score)
