"""Whole Arrow batches as flat byte and word arrays, and 64-bit hashes of words and windows.

A slice holds some documents of one batch; words never cross documents. All arithmetic on
``uint64`` wraps around.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that one slice holds, unless a single document is larger.
SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def byte_table(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


#: Bytes of ``[^\\x20\\x09-\\x0D]`` and of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``.
NOT_BLANK = ~byte_table(b" \t\n\v\f\r")
ALPHANUMERIC = byte_table(b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd base and of its inverse, grown on demand."""

    def __init__(self, base: np.uint64):
        self.base = base
        self.inverse = np.uint64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, factor in (("up", self.base), ("down", self.inverse)):
                run = np.full(n, factor, np.uint64)
                run[0] = 1
                setattr(self, name, np.multiply.accumulate(run))
        return self.up[:n], self.down[:n]


_BYTE_POWERS, _WORD_POWERS = _Powers(_BASE), _Powers(_STEP)


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers) -> np.ndarray:
    """Polynomial hash of ``values[starts:ends]`` for every pair, from one running sum."""
    up, down = powers.upto(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


@dataclass
class Words:
    """Words of some consecutive documents of a batch."""

    data: np.ndarray
    #: Byte offsets of the documents, one more than there are documents.
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    #: First word of every document, and the number of words at the end.
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        raw = range_hash(self.data.astype(np.uint64), self.starts, self.ends, _BYTE_POWERS)
        return mixed(raw + (self.ends - self.starts).astype(np.uint64) * _STEP)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of all windows of ``size`` words in one document."""
        last = np.repeat(self.first[1:], self.counts) - size
        begin = np.flatnonzero(np.arange(len(self.starts)) <= last)
        return begin, mixed(range_hash(self.hashes(), begin, begin + size, _WORD_POWERS))


def document_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column and the offsets of its values; null counts as empty."""
    column = column.fill_null(b"") if column.null_count else column
    wide = pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data, offsets


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``most`` bytes."""
    begin, n = 0, len(offsets) - 1
    while begin < n:
        end = int(np.searchsorted(offsets, offsets[begin] + most, "right")) - 1
        end = min(max(end, begin + 1), n)
        yield begin, end
        begin = end


def parted(
    data: np.ndarray, offsets: np.ndarray, cuts: Callable[[np.ndarray], np.ndarray], most: int
) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, document of each part) with documents over ``most`` bytes cut where ``cuts`` allows.

    A part is longer only if there is no such place in it.
    """
    sizes = np.diff(offsets)
    if not (sizes > most).any():
        return offsets, np.arange(len(sizes))
    begins, owner = [], []
    for document, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        begins.append(a)
        owner.append(document)
        width = most
        while b - a > most:
            found = np.flatnonzero(cuts(data[a : min(a + width, b)]))
            found = found[found > 0]
            if len(found):
                a, width = a + int(found[-1]), most
                begins.append(a)
                owner.append(document)
            elif a + width >= b:
                break
            else:
                width *= 2
    return np.array([*begins, int(offsets[-1])], np.int64), np.array(owner, np.int64)


def words_of(data: np.ndarray, offsets: np.ndarray, members: np.ndarray) -> Words:
    """Maximal runs of ``members`` bytes inside the documents ``offsets`` delimits."""
    base = offsets[0]
    data, offsets = data[base : offsets[-1]], offsets - base
    inside = members[data]
    begins, ends = inside.copy(), inside.copy()
    if len(data):
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        heads = offsets[:-1][np.diff(offsets) > 0]
        tails = offsets[1:][np.diff(offsets) > 0] - 1
        begins[heads], ends[tails] = inside[heads], inside[tails]
    starts = np.flatnonzero(begins)
    return Words(data, offsets, starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets))


def batches_of(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) for f in schema], schema=schema
    )
