"""The words of a whole Arrow column of texts at once, by classes of bytes.

A class table says of each byte whether it belongs to a word.  Only ASCII bytes part words, so
cutting UTF-8 there leaves whole characters.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 8_000_000
LOWER = np.arange(256, dtype="u1")
LOWER[list(string.ascii_uppercase.encode())] = list(string.ascii_lowercase.encode())


def byte_class(without: bytes) -> np.ndarray:
    """A table that is true for all bytes but those of ``without``."""
    table = np.ones(256, bool)
    table[list(without)] = False
    return table


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column without nulls, and where each row begins and ends in them."""
    if not len(column):
        return np.zeros(0, "u1"), np.zeros(1, "i8")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, "i8" if wide else "i4")[column.offset:column.offset + len(column) + 1].astype("i8")
    data = np.frombuffer(data, "u1") if data is not None else np.zeros(0, "u1")
    return data[at[0]:at[-1]], at - at[0]


def byte_slices(batch: pa.RecordBatch, text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of about ``size`` bytes of text; a longer text is a slice of its own."""
    _, at = bytes_of(batch.column(text))
    group = at[:-1] // size
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def runs(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the maximal runs of true bytes, none of which reaches into another row."""
    if not len(inside):
        return np.zeros(0, "i8"), np.zeros(0, "i8")
    edge = np.zeros(len(inside) + 1, bool)
    edge[at] = True
    before = np.concatenate([[False], inside[:-1]])
    after = np.concatenate([inside[1:], [False]])
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends


@dataclass
class Words:
    """Words in order: where they are, the row of each, and its number among the ``distinct`` ones."""

    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    codes: np.ndarray
    distinct: pa.Array


def words_of(data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> Words:
    """``inside``: which bytes belong to words."""
    starts, ends = runs(inside, at)
    counts = np.diff(np.searchsorted(starts, at))
    rows = np.repeat(np.arange(len(counts)), counts)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype("i8")
    plain = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[inside]))]
    )
    coded = plain.dictionary_encode()
    return Words(starts, ends, rows, coded.indices.to_numpy().astype("i8"), coded.dictionary)


def row_sums(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of a row's bytes are true."""
    total = np.concatenate([[0], np.cumsum(flags, dtype="i8")])
    return total[at[1:]] - total[at[:-1]]
