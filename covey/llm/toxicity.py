"""Toxicity of a text by a bidirectional gated recurrent network with attention pooling.

Two levels of the same cell. A word's bytes go through a small network in both directions; its two
last states, beside a learned vector of the word itself (by hash), are the word's input. Windows
of words go through a second network in both directions, and attention pools the states of all
steps into the window's logit. Windows overlap, and all windows of the whole text are scored. A
logistic layer over the mean and the largest window probability makes the text's score.

Everything is trained in numpy on a bounded sample: of the documents whose label may be learned,
the ``toxic_documents`` labelled 1 and the ``clean_documents`` labelled 0 with the smallest hashes, up to
``windows_each`` windows of each, spread over the text. Three quarters train the network, the rest the last
layer, weighted to the shares of all labels.

Defined cases: a document with several labels is toxic if one of them is 1; null labels and null
ids teach nothing. A text that is null or has no word scores 0. Without any label 1, or any label
0, every text scores the share of labels 1 (0 without labels). Texts of any length are scored
whole, a bounded stretch at a time; words beyond ``LONGEST`` bytes count as several. Repeated rows are all scored;
an empty table gives none. Columns named like the results are replaced, others stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covey.functions.columns import column
from covey.llm.columns import Words, find_words, text_buffer, texts, word_hashes

STEPS = 64
STRIDE = 48
LONGEST = 32
THRESHOLD = 0.3
_CHAR, _CHAR_STATE, _WORD, _STATE, _BUCKETS = 8, 12, 8, 12, 1 << 13
_STRETCH = 1 << 20
_SIFT, _MOST, _DECAY = (0.3, 0.6), 0.9, 0.06
_WINDOWS_AT_ONCE = 2048
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Cell:
    """Gated recurrent cell: update, reset and candidate side by side."""

    inputs: np.ndarray
    states: np.ndarray
    bias: np.ndarray


@dataclass
class Network:
    chars: np.ndarray
    words: np.ndarray
    char_cells: list[Cell]  # forward and backward
    word_cells: list[Cell]
    attention: np.ndarray
    out: np.ndarray
    offset: np.ndarray
    last: np.ndarray = field(default_factory=lambda: np.zeros(3))  # constant, mean, largest

    def parameters(self) -> list[np.ndarray]:
        cells = [p for c in (*self.char_cells, *self.word_cells) for p in (c.inputs, c.states, c.bias)]
        return [self.chars, self.words, *cells, self.attention, self.out, self.offset]


def _new_network() -> Network:
    pick = np.random.default_rng(13)

    def some(spread: float, *shape: int) -> np.ndarray:
        return pick.normal(0, spread, shape).astype(np.float32)

    def cell(inputs: int, width: int) -> Cell:
        return Cell(some(inputs**-0.5, inputs, 3 * width), some(width**-0.5, width, 3 * width), np.zeros(3 * width, np.float32))

    both = 2 * _STATE
    return Network(
        some(0.5, 256, _CHAR),
        some(0.1, _BUCKETS, _WORD),
        [cell(_CHAR, _CHAR_STATE) for _ in range(2)],
        [cell(_WORD + 2 * _CHAR_STATE, _STATE) for _ in range(2)],
        some(both**-0.5, both),
        some(both**-0.5, both),
        np.zeros(1, np.float32),
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class _Run:
    """Sequences as rows, longest first: at step t the first ``live[t]`` rows go on. ``index`` holds each
    step's row of the table of projected inputs."""

    index: np.ndarray
    live: np.ndarray
    kept: list[tuple[np.ndarray, ...]] = field(default_factory=list)

    def forward(self, table: np.ndarray, states: np.ndarray, keep: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """All states (step x row; zero after a row's end) and the last ones."""
        steps, rows = self.index.shape
        width = len(states)
        h = np.zeros((rows, width), np.float32)
        out = np.zeros((steps, rows, width), np.float32)
        for t in range(steps):
            m = int(self.live[t])
            x, before = table[self.index[t, :m]], h[:m]
            g = before @ states
            gates = _sigmoid(x[:, : 2 * width] + g[:, : 2 * width])
            update, reset = gates[:, :width], gates[:, width:]
            new = np.tanh(x[:, 2 * width :] + reset * g[:, 2 * width :])
            if keep:
                self.kept.append((before.copy(), update, reset, new, g[:, 2 * width :]))
            out[t, :m] = new + update * (before - new)
            h[:m] = out[t, :m]
        return out, h

    def backward(self, states: np.ndarray, d_out: np.ndarray | None, d_last: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of the table (``rows`` long) and of the cell's state matrix."""
        d_states, d = np.zeros_like(states), d_last.copy()
        given: list[np.ndarray] = []
        for t in range(len(self.index) - 1, -1, -1):
            m = int(self.live[t])
            before, update, reset, new, g = self.kept[t]
            here = d[:m] if d_out is None else d[:m] + d_out[t, :m]
            d_new = here * (1 - update) * (1 - new * new)
            d_update = here * (before - new) * update * (1 - update)
            d_reset = d_new * g * reset * (1 - reset)
            d_g = np.concatenate([d_update, d_reset, d_new * reset], 1)
            given.append(np.concatenate([d_update, d_reset, d_new], 1))
            d_states += before.T @ d_g
            d[:m] = here * update + d_g @ states.T
        return _added(np.concatenate([self.index[t, : self.live[t]] for t in range(len(self.index) - 1, -1, -1)]), np.concatenate(given), rows), d_states


def _added(index: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    """Values summed by index."""
    out = np.zeros((rows, values.shape[1]), np.float32)
    order = np.argsort(index, kind="stable")
    sorted_ = index[order]
    starts = np.append(0, np.flatnonzero(sorted_[1:] != sorted_[:-1]) + 1)
    out[sorted_[starts]] = np.add.reduceat(values[order], starts, 0)
    return out


def _runs(size: np.ndarray, steps: int, at: np.ndarray, of: np.ndarray) -> tuple[_Run, _Run]:
    """Forward and backward sequences ``of[at] ... of[at + size - 1]``; the sizes fall."""
    t = np.arange(steps)[:, None]
    live = np.searchsorted(-size, -np.arange(steps), "left")
    ahead = of[at + np.minimum(t, size - 1)]
    back = of[at + np.maximum(size - 1 - t, 0)]
    return _Run(ahead, live), _Run(back, live)


@dataclass
class _Vocabulary:
    """Distinct words of a stretch, longest first, with their bytes' place."""

    buckets: np.ndarray
    at: np.ndarray
    size: np.ndarray
    data: np.ndarray

    def runs(self) -> tuple[_Run, _Run]:
        return _runs(self.size, int(self.size.max(initial=0)), self.at, self.data)


def _distinct(data: np.ndarray, words: Words) -> tuple[_Vocabulary, np.ndarray]:
    """The distinct words, and which of them each word is."""
    hashes = word_hashes(data, words, lower=True, alnum=True)
    _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    size = (words.ends - words.starts)[first]
    order = np.argsort(-size, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    first = first[order]
    found = _Vocabulary((hashes[first] % np.uint64(_BUCKETS)).astype(np.int64), words.starts[first], size[order], _LOWER[data])
    return found, place[inverse]


def _split(words: Words) -> Words:
    """Words beyond ``LONGEST`` bytes as several."""
    size = words.ends - words.starts
    if size.max(initial=0) <= LONGEST:
        return words
    many = -(-size // LONGEST)
    before = np.append(0, np.cumsum(many))
    k = np.arange(before[-1]) - np.repeat(before[:-1], many)
    starts = np.repeat(words.starts, many) + k * LONGEST
    return Words(starts, np.minimum(starts + LONGEST, np.repeat(words.ends, many)), before[words.first])


def _inputs(net: Network, vocabulary: _Vocabulary, keep: bool = False) -> tuple[np.ndarray, tuple[_Run, ...]]:
    """Each distinct word's input: its own vector and the last states over its bytes."""
    runs = vocabulary.runs()
    last = [r.forward(net.chars @ c.inputs + c.bias, c.states, keep)[1] for r, c in zip(runs, net.char_cells, strict=True)]
    return np.concatenate([net.words[vocabulary.buckets], *last], 1), runs


@dataclass
class _Pooled:
    states: list[np.ndarray]
    shares: list[np.ndarray]
    pooled: np.ndarray
    logit: np.ndarray


def _pool(net: Network, ahead: np.ndarray, back: np.ndarray, size: np.ndarray) -> _Pooled:
    """Attention over the steps: shares by softmax of the two directions' scores together."""
    width, steps = ahead.shape[2], len(ahead)
    t, rows = np.arange(steps)[:, None], np.arange(len(size))
    # The backward state of step t was made at step size - 1 - t.
    turned = np.maximum(size - 1 - t, 0)
    scores = ahead @ net.attention[:width] + (back @ net.attention[width:])[turned, rows]
    scores = np.where(t < size, scores, -np.inf)
    share = np.exp(scores - scores.max(0))
    share /= share.sum(0)
    back_share = np.where(t < size, share[turned, rows], 0)
    pooled = np.concatenate([np.einsum("tb,tbw->bw", s, x) for s, x in ((share, ahead), (back_share, back))], 1)
    return _Pooled([ahead, back], [share, back_share], pooled, pooled @ net.out + net.offset)


def _gradients(net: Network, data: np.ndarray, words: Words, at: np.ndarray, size: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    vocabulary, of = _distinct(data, words)
    inputs, char_runs = _inputs(net, vocabulary, keep=True)
    runs = _runs(size, int(size[0]), at, of)
    tables = [inputs @ c.inputs + c.bias for c in net.word_cells]
    states = [r.forward(x, c.states, True)[0] for r, x, c in zip(runs, tables, net.word_cells, strict=True)]
    got = _pool(net, *states, size)
    miss = ((_sigmoid(got.logit) - labels) / len(labels)).astype(np.float32)
    d_pooled = miss[:, None] * net.out
    width, steps, rows = _STATE, len(states[0]), np.arange(len(size))
    halves = [d_pooled[:, :width], d_pooled[:, width:]]
    turned = np.maximum(size - 1 - np.arange(steps)[:, None], 0)
    inside = np.arange(steps)[:, None] < size
    # Through the shares: what each step's state would have added, less the mean of that.
    worth = np.einsum("tbw,bw->tb", states[0], halves[0]) + np.einsum("tbw,bw->tb", states[1], halves[1])[turned, rows]
    d_scores = got.shares[0] * (worth - (got.shares[0] * worth).sum(0))
    d_turned = np.where(inside, d_scores[turned, rows], 0)
    d_attention = np.concatenate([np.einsum("tb,tbw->w", s, x) for s, x in zip((d_scores, d_turned), states, strict=True)])
    d_inputs, cells = np.zeros_like(inputs), []
    for k, (run, cell) in enumerate(zip(runs, net.word_cells, strict=True)):
        score = (d_scores, d_turned)[k]
        d_out = got.shares[k][:, :, None] * halves[k] + score[:, :, None] * net.attention[k * width : (k + 1) * width]
        d_table, d_states = run.backward(cell.states, d_out, np.zeros((len(size), width), np.float32), len(inputs))
        cells += [inputs.T @ d_table, d_states, d_table.sum(0)]
        d_inputs += d_table @ cell.inputs.T
    d_words = _added(vocabulary.buckets, d_inputs[:, :_WORD], _BUCKETS)
    d_chars, char_cells = np.zeros_like(net.chars), []
    for k, (run, cell) in enumerate(zip(char_runs, net.char_cells, strict=True)):
        start = _WORD + k * _CHAR_STATE
        d_table, d_states = run.backward(cell.states, None, d_inputs[:, start : start + _CHAR_STATE], 256)
        char_cells += [net.chars.T @ d_table, d_states, d_table.sum(0)]
        d_chars += d_table @ cell.inputs.T
    return [d_chars, d_words, *char_cells, *cells, d_attention, miss @ got.pooled, miss.sum(keepdims=True)]


def train(windows: list[bytes], labels: np.ndarray, owner: np.ndarray, steps: int = 700, batch: int = 64) -> Network:
    """Fit by Adam on cross entropy, half of each batch toxic; the same input gives the same network.

    Not every window of a toxic text is toxic. From ``_SIFT`` of the steps on, those go that look
    no more toxic than most windows of clean texts, but a text's most toxic one stays.
    """
    net, pick = _new_network(), np.random.default_rng(7)
    sides = [np.flatnonzero(labels == k) for k in (0, 1)]
    params = net.parameters()
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, steps + 1):
        if step in [int(steps * part) for part in _SIFT]:
            p = _probabilities(net, windows)
            top = np.zeros(owner.max() + 1, np.float32)
            np.maximum.at(top, owner, p)
            toxic = (labels == 1) & ((p > np.quantile(p[labels == 0], _MOST)) | (p == top[owner]))
            sides[1] = np.flatnonzero(toxic)
        rows = np.concatenate([pick.choice(side, batch // 2) for side in sides])
        data, offsets = _joined([windows[i] for i in rows])
        words = _split(find_words(data, offsets, alnum=True))
        size = np.diff(words.first)
        order = np.argsort(-size, kind="stable")
        grads = _gradients(net, data, words, words.first[:-1][order], size[order], labels[rows][order])
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in grads)))
        rate = 0.01 if step <= steps * 0.6 else 0.003
        for p, g, (m, v) in zip(params, grads, moments, strict=True):
            g = g * min(1.0, 1.0 / max(norm, 1e-12))
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * ((m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8) + _DECAY * p)
    return net


def _probabilities(net: Network, windows: list[bytes]) -> np.ndarray:
    out = []
    for a in range(0, len(windows), _WINDOWS_AT_ONCE):
        data, offsets = _joined(windows[a : a + _WINDOWS_AT_ONCE])
        words = _split(find_words(data, offsets, alnum=True))
        out.append(window_probabilities(net, data, words, words.first[:-1], np.diff(words.first)))
    return np.concatenate(out)


def _joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])


def _window_places(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, words and text of each window over texts whose words begin at ``first``."""
    many = np.diff(first)
    each = np.where(many > 0, 1 + np.maximum(0, -(-(many - STEPS) // STRIDE)), 0)
    owner = np.repeat(np.arange(len(many)), each)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)
    at = first[owner] + k * STRIDE
    return at, np.minimum(STEPS, first[owner + 1] - at), owner


def _stretches(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, Words, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, words and windows (first word, words, text) of a batch; a single long text comes in
    stretches that go on where the next window begins."""
    if len(offsets) > 2 or len(data) <= 2 * _STRETCH:
        words = _split(find_words(data, offsets, alnum=True))
        yield data, words, *_window_places(words.first)
        return
    a, most = 0, _STRETCH
    while True:
        part = data[a : a + most]
        words = _split(find_words(part, np.array([0, len(part)]), alnum=True))
        at, size, owner = _window_places(words.first)
        if a + most >= len(data):
            yield part, words, at, size, owner
            return
        # The last word may go on beyond the stretch, so only windows before it are whole.
        whole = int((at + STEPS < len(words.starts)).sum())
        if not whole:
            most *= 2
            continue
        yield part, words, at[:whole], size[:whole], owner[:whole]
        a, most = a + int(words.starts[whole * STRIDE]), _STRETCH


def window_probabilities(net: Network, data: np.ndarray, words: Words, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Probability of each window of ``size`` words from word ``at``."""
    out = np.zeros(len(at), np.float32)
    if not len(at):
        return out
    vocabulary, of = _distinct(data, words)
    inputs, _ = _inputs(net, vocabulary)
    tables = [inputs @ c.inputs + c.bias for c in net.word_cells]
    order = np.argsort(-size, kind="stable")
    for a in range(0, len(order), _WINDOWS_AT_ONCE):
        rows = order[a : a + _WINDOWS_AT_ONCE]
        runs = _runs(size[rows], int(size[rows[0]]), at[rows], of)
        states = [r.forward(x, c.states)[0] for r, x, c in zip(runs, tables, net.word_cells, strict=True)]
        out[rows] = _sigmoid(_pool(net, *states, size[rows]).logit)
    return out


def text_evidence(net: Network, texts_: pa.Array) -> np.ndarray:
    """Of each text: windows, mean and largest window probability."""
    data, offsets = text_buffer(texts_)
    out = np.zeros((len(texts_), 3))
    for part, words, at, size, owner in _stretches(data, offsets):
        p = window_probabilities(net, part, words, at, size)
        np.add.at(out[:, 0], owner, 1)
        np.add.at(out[:, 1], owner, p)
        np.maximum.at(out[:, 2], owner, p)
    out[:, 1] /= np.maximum(out[:, 0], 1)
    return out


def _fit_last(evidence: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Logistic regression on mean and largest probability, by Newton's steps with a small ridge."""
    x = np.column_stack([np.ones(len(labels)), evidence[:, 1:]])
    w, ridge = np.zeros(3), np.diag([1e-6, 0.05, 0.05]) * weights.sum() / 100
    for _ in range(50):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x * (weights * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weights * (labels - p)) - ridge @ w)
        w += step
        if abs(step).max() < 1e-9:
            break
    return w


@dataclass
class Scorer:
    """A network, or only the share of labels 1 where there is nothing to tell apart."""

    net: Network | None
    share: float

    def scores(self, texts_: pa.Array) -> np.ndarray:
        if self.net is None:
            return np.full(len(texts_), self.share)
        seen = text_evidence(self.net, texts_)
        p = _sigmoid(np.column_stack([np.ones(len(seen)), seen[:, 1:]]) @ self.net.last)
        return np.where(seen[:, 0] > 0, p, 0)


def learnable(key: str = "doc_id") -> Column:
    """Rows whose label may be learned; null for a null id."""
    return F.crc32(column(key).cast("string")) % 4 != 2


def fit(docs: DataFrame, labels: DataFrame, toxic_documents: int = 800, clean_documents: int = 1600, windows_each: int = 24) -> Scorer:
    """Learn from ``labels (doc_id, toxic)`` of documents that are not held out.

    The sampled ids are bounded by the parameters, so they are sent to all tasks."""
    known = (
        labels.filter(learnable() & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    )
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        return Scorer(None, counts.get(1, 0) / total if total else 0.0)
    bounds = {1: toxic_documents, 0: clean_documents}
    ids: list[tuple] = []
    for kind, most in bounds.items():
        # Few rows beyond the bound pass the hash, and the least hashes of these are taken.
        share = min(1.0, 1.25 * most / counts[kind] + 100 / counts[kind])
        few = known.filter((F.col("toxic") == kind) & (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20)))
        ids += few.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()
    sampled = docs.sparkSession.createDataFrame(ids, known.schema)
    texts_ = docs.select("doc_id", "text").join(F.broadcast(sampled), "doc_id")
    rows = sorted(texts_.select("doc_id", "toxic", "text").mapInArrow(_cut(windows_each), "doc_id string, toxic int, part int, bytes binary").distinct().collect())
    return _learn(rows, counts)


def _cut(windows_each: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts(batches, "text", _STRETCH):
            data, offsets = text_buffer(batch.column("text"))
            words = _split(find_words(data, offsets, alnum=True))
            at, size, owner = _window_places(words.first)
            first = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            keep = [
                np.unique(np.linspace(a, b - 1, min(windows_each, b - a)).astype(np.int64))
                for a, b in zip(first[:-1], first[1:], strict=True)
                if b > a
            ]
            take = np.concatenate(keep) if keep else np.zeros(0, np.int64)
            parts = [data[words.starts[i] : words.ends[i + n - 1]].tobytes() for i, n in zip(at[take], size[take], strict=True)]
            of = pa.array(owner[take])
            yield pa.record_batch(
                [
                    batch.column("doc_id").take(of).cast(pa.string()),
                    batch.column("toxic").take(of).cast(pa.int32()),
                    pa.array((take - first[owner[take]]).astype(np.int32)),
                    pa.array(parts, pa.binary()),
                ],
                ["doc_id", "toxic", "part", "bytes"],
            )

    return cut


def _learn(rows: list, counts: dict[int, int]) -> Scorer:
    """Three documents of four train the network, the fourth the last layer."""
    base = counts[1] / sum(counts.values())
    order = {d: k for k, d in enumerate(dict.fromkeys(r["doc_id"] for r in rows))}
    split = {True: [], False: []}
    for r in rows:
        split[order[r["doc_id"]] % 4 == 3].append(r)
    labels = np.array([r["toxic"] for r in split[False]])
    if len(set(labels.tolist())) < 2:
        return Scorer(None, base)
    _, owner = np.unique([r["doc_id"] for r in split[False]], return_inverse=True)
    net = train([bytes(r["bytes"]) for r in split[False]], labels, owner)
    # With too few documents apart, the last layer learns from all of them.
    apart = split[True] if len({r["toxic"] for r in split[True]}) == 2 else rows
    p = _probabilities(net, [bytes(r["bytes"]) for r in apart])
    docs, of = np.unique([r["doc_id"] for r in apart], return_inverse=True)
    evidence = np.zeros((len(docs), 3))
    np.add.at(evidence[:, 0], of, 1)
    np.add.at(evidence[:, 1], of, p)
    np.maximum.at(evidence[:, 2], of, p)
    evidence[:, 1] /= evidence[:, 0]
    toxic = np.zeros(len(docs))
    toxic[of] = [r["toxic"] for r in apart]
    natural = np.where(toxic == 1, base / max(toxic.mean(), 1e-12), (1 - base) / max(1 - toxic.mean(), 1e-12))
    net.last = _fit_last(evidence, toxic, natural)
    return Scorer(net, base)


def score(docs: DataFrame, scorer: Scorer, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1) and ``toxic_pred`` (1 from ``threshold``) added. Row-local."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    plain = docs.drop("toxicity", "toxic_pred")
    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in plain.schema)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts(batches, "text", _STRETCH):
            p = shared.value.scores(batch.column("text"))
            yield pa.record_batch(
                [*batch.columns, pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32))],
                [*batch.schema.names, "toxicity", "toxic_pred"],
            )

    return plain.mapInArrow(apply, f"{schema}, toxicity double, toxic_pred int")
