"""Plain versions of the operators, for small tables."""

import collections
import re

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, width=5):
    w = WORD.findall((text or "").translate(_LOWER))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())


def classes(sets, percent=80):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[:i]:
            shared = len(sets[a] & sets[b])
            if sets[a] and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def byte_repeats(rows, span):
    """(doc_id, bytes, removed, spans, kept) with strings that also start earlier removed."""
    seen, out = set(), []
    for i, text in rows:
        data = (text or "").encode()
        keep = [True] * len(data)
        for p in range(len(data) - span + 1):
            s = data[p : p + span]
            if s in seen:
                keep[p : p + span] = [False] * span
            seen.add(s)
        kept = bytes(c for c, k in zip(data, keep, strict=True) if k)
        spans = sum(not k and (p == 0 or keep[p - 1]) for p, k in enumerate(keep))
        out.append((i, len(data), len(data) - len(kept), spans, kept))
    return out


def window_repeats(rows, span):
    """(doc_id, words, removed, kept) with windows that also start elsewhere removed."""
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    count = collections.Counter(tuple(w[p : p + span]) for _, w in words for p in range(len(w) - span + 1))
    out = []
    for i, w in words:
        keep = [True] * len(w)
        for p in range(len(w) - span + 1):
            if count[tuple(w[p : p + span])] > 1:
                keep[p : p + span] = [False] * span
        kept = " ".join(x for x, k in zip(w, keep, strict=True) if k)
        out.append((i, len(w), len(w) - sum(keep), kept.encode()))
    return out


def cosine_links(vectors, threshold=0.95):
    x = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    return near


def leaks(docs, items, stretch=13, replaced=2, shortest=5):
    """(doc_id, item_id, shift) of every alignment in which an item leaks."""
    split = re.compile(r"[0-9a-z\x80-\U0010ffff]+")
    out = set()
    for doc, text in docs:
        w = split.findall((text or "").translate(_LOWER))
        for item, passage in items:
            v = split.findall((passage or "").translate(_LOWER))
            n, most = (stretch, replaced) if len(v) >= stretch else (len(v), 0)
            if n < shortest:
                continue
            for shift in range(-len(v) + 1, len(w)):
                for a in range(max(shift, 0), min(shift + len(v), len(w)) - n + 1):
                    if sum(w[a + k] != v[a + k - shift] for k in range(n)) <= most:
                        out.add((doc, item, shift))
                        break
    return out
