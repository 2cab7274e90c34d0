"""Tokens of a document's sections, from one encoding of the whole document.

Encoding sections one by one gives other tokens than they have in the document, as merges reach
over the borders. So the whole document is encoded once; each token's characters are known from
the lengths of the tokens' bytes; and the tokens' spans are joined with the sections' spans. As
both are in order, the join is a binary search of the borders.

A token that crosses borders is allocated by the rule:

* ``majority``: to the section with most of its bytes, of equals to the first (whole numbers);
* ``start``: to the section in which it starts;
* ``share``: to each section the share of its bytes that lie there (fractions).

A document's counts add up to its number of tokens under each rule, as sections tile the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from covey.llm import bpe, columns

RULES = ("majority", "start", "share")


def line_sections(data: np.ndarray) -> np.ndarray:
    """Borders of a text's lines, each with its line end: 0, ends. An empty text has one section."""
    ends = np.flatnonzero(data == 10) + 1
    borders = np.append(0, ends) if len(ends) and ends[-1] == len(data) else np.concatenate([[0], ends, [len(data)]])
    return borders


def allocate(sizes: np.ndarray, borders: np.ndarray, rule: str = "majority") -> np.ndarray:
    """Tokens of each section: ``sizes`` are the tokens' bytes in order, ``borders`` the n+1
    bytes at which the n sections begin and end."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    n = len(borders) - 1
    # Empty sections can't hold a byte: the section of a byte is the last that begins at or before.
    first = np.searchsorted(borders[1:], starts, "right")
    last = np.searchsorted(borders[1:], ends - 1, "right")
    out = np.bincount(first[first == last], minlength=n).astype(np.float64)
    for i in np.flatnonzero(first != last).tolist():
        a, b = int(first[i]), int(last[i])
        inside = np.minimum(borders[a + 1 : b + 2], ends[i]) - np.maximum(borders[a : b + 1], starts[i])
        if rule == "share":
            out[a : b + 1] += inside / sizes[i]
        else:
            out[a + (int(inside.argmax()) if rule == "majority" else 0)] += 1
    return out


def section_tokens(docs: DataFrame, path: str, pattern: str, rule: str = "majority") -> DataFrame:
    """``doc_id, section, char_start, char_stop, n_tokens`` for every line of every text.

    Spans are in characters of the whole text. A line takes its line end along. A null or empty
    text has one empty section without tokens. Rows are treated one by one, so repeated rows and
    null or repeated doc_id give their own rows.
    """
    if rule not in RULES:
        raise ValueError(f"rule has to be one of {RULES}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.coder(path, pattern)
        for part in columns.texts(batches, "text", 1 << 21):
            data, at = columns.text_buffer(part.column(1))
            found = coder.encode_many([t or "" for t in part.column(1).to_pylist()])
            rows, section, start, stop, tokens = [], [], [], [], []
            for i, ids in enumerate(found):
                text = data[at[i] : at[i + 1]]
                borders = line_sections(text)
                chars = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])[borders]
                rows.append(np.full(len(borders) - 1, i))
                section.append(np.arange(len(borders) - 1))
                start.append(chars[:-1]), stop.append(chars[1:])
                tokens.append(allocate(coder.lengths[ids], borders, rule))
            got = [np.concatenate(x) for x in (rows, section, start, stop, tokens)]
            n = got[4] if rule == "share" else got[4].astype(np.int64)
            yield pa.record_batch(
                [part.column(0).take(pa.array(got[0])), *map(pa.array, got[1:4]), pa.array(n)],
                ["doc_id", "section", "char_start", "char_stop", "n_tokens"],
            )

    number = "double" if rule == "share" else "long"
    return docs.select("doc_id", "text").mapInArrow(
        count, f"doc_id long, section long, char_start long, char_stop long, n_tokens {number}"
    )
