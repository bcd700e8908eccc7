"""What the training-data operators share: shared storage, shipping of this package, and byte-level text arrays."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from cadenza.shipping import ship
from cadenza.storage import Scratch, shared_dir

__all__ = ["LOWER", "SPACE", "Scratch", "mix", "sequence_bytes", "shared_dir", "ship", "slices", "text_bytes", "trim", "word_hashes", "words"]

#: The bytes of `[\x20\x09-\x0D]`, which separate words.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, and offsets of its rows (one more than rows). Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of whole rows holding about `most` bytes at most; a longer row is a run of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word of the rows, and its row. Words are runs of bytes outside SPACE and never cross rows."""
    gap = np.ones(len(raw) + 1, bool)
    np.take(SPACE, raw, out=gap[:-1])
    edge = np.zeros(len(raw) + 1, bool)  # a row's first byte begins a word even if the row before ends in one
    edge[offsets[:-1]] = True
    before = np.empty(len(raw) + 1, bool)
    before[0], before[1:] = True, gap[:-1]
    starts = np.flatnonzero(~gap & (before | edge))
    ends = np.flatnonzero((gap | edge) & ~before)
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


_M = (1 << 64) - 1
_P = 0x9E3779B97F4A7C15
_INV = pow(_P, -1, 1 << 64)
_T = np.random.RandomState(20240229).randint(0, 1 << 62, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_pow = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_pow[0]) < n:
        with np.errstate(over="ignore"):
            for k, base in enumerate((_P, _INV)):
                x = np.full(max(n, 1 << 16), base, np.uint64)
                x[0] = 1
                _pow[k] = np.multiply.accumulate(x)
    return _pow[0], _pow[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span: a polynomial over random byte values, differenced out of one prefix sum."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    if len(raw) > 2 << 20:  # one long text: hash it in pieces, so that the sums and powers stay small
        cuts = np.flatnonzero(np.diff(starts >> 20)) + 1
        parts = zip(np.split(starts, cuts), np.split(ends, cuts), strict=True)
        return np.concatenate([_span_hashes(raw[a[0] : b[-1]], a - a[0], b - a[0]) for a, b in parts])
    return _span_hashes(raw, starts, ends)


def _span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    power, inverse = _powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_T[raw] * power[: len(raw)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def trim() -> None:
    """Give freed memory back to the system: a worker that waits for its next task then holds little."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def sequence_bytes(batch: pa.RecordBatch, name: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows [i, j) of a batch with the bytes and offsets of a text column, in runs of bounded size."""
    raw, offsets = text_bytes(batch.column(batch.schema.get_field_index(name)))
    for i, j in slices(offsets):
        yield i, j, raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]


