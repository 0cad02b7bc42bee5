"""Byte n-grams of whole texts, from Arrow's buffers, as slots of a table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def pieces(batches: Iterator[pa.RecordBatch], column: int, size: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text (a longer text alone), which bounds the arrays made of them."""
    for batch in batches:
        if batch.num_rows:
            lengths = np.asarray(pc.binary_length(batch.column(column)), dtype=np.int64)
            part = (np.cumsum(lengths) - lengths) // size
            edges = np.flatnonzero(np.r_[True, np.diff(part) > 0, True]).tolist()
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                yield batch.slice(low, high - low)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column without nulls, end to end, and the offsets of its texts."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slots(raw: np.ndarray, order: int, bits: int) -> np.ndarray:
    """Slot (of ``2 ** bits``) of the n-gram that begins at every byte; the last ``order - 1`` bytes begin none."""
    n = max(len(raw) - order + 1, 0)
    code = np.zeros(n, np.uint64)
    for i in range(order):
        code = code << np.uint64(8) | raw[i : i + n]
    if 8 * order > bits:
        code = code * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)
    return code.astype(np.int32)


def plain_bytes() -> np.ndarray:
    """Table of bytes: letters in lower case, digits and marks as blanks."""
    table = np.arange(256, dtype=np.uint8)
    table[:128] = 32
    lower = np.arange(ord("a"), ord("z") + 1, dtype=np.uint8)
    table[lower] = lower
    table[lower - 32] = lower
    return table
