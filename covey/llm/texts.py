"""Texts sent over a shuffle: only those that are asked for, and compressed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from covey.llm.columns import release, text_buffer
from covey.llm.components import bitmap, passes

PACKED = "doc_id long, packed binary"


def packed(docs: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """``doc_id, packed``: whole texts, compressed; null is empty. With ``ids (doc_id)`` only the
    documents that may be among them, so a join on doc_id has to follow."""
    wanted = None if ids is None else bitmap(ids, "doc_id")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            if wanted is not None and batch.num_rows:
                batch = batch.filter(pa.array(passes(wanted.value, batch.column(0).to_numpy())))
            if not batch.num_rows:
                continue
            data, at = text_buffer(batch.column(1))
            out = [press.compress(data[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.record_batch([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "packed"])

    return docs.select("doc_id", "text").mapInArrow(pack, PACKED)


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of packed texts."""
    press = zstandard.ZstdDecompressor()
    parts = [press.decompress(x) for x in column.to_pylist()]
    at = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=at[1:])
    return np.frombuffer(b"".join(parts), np.uint8), at


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Batches cut so that a piece holds at most about ``most`` packed bytes, or one row."""
    for batch in batches:
        at = text_buffer(batch.column(column))[1]
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(at, at[a] + most, "right")) - 1)
            yield batch.slice(a, b - a)
            a = b
    release()
