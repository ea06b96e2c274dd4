"""Vectorized words of Arrow text columns: byte spans and 64-bit hashes.

A word's hash is a difference of prefix sums, so all words of a chunk are hashed
without a Python loop. Chunks end between words and are bounded, so one very long
text does not raise the memory of a task.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
U64 = np.uint64

#: the white space of the contracts: space, and 9 to 13
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: everything but letters and bytes above ASCII
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[65:91] = NOT_LETTER[97:123] = NOT_LETTER[128:] = False


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """The splitmix64 finalizer."""
    with np.errstate(over="ignore"):
        x = x + U64((seed * BASE + BASE) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


#: lower-cased bytes to random numbers (A-Z only)
_LETTER = np.arange(256)
_LETTER[65:91] += 32
BYTE_VALUE = mix(_LETTER.astype(U64), 7)
_POW: list[np.ndarray] = []


def _power_tables() -> list[np.ndarray]:
    if not _POW:
        _POW.extend([_powers(BASE, CHUNK + 1), _powers(pow(BASE, -1, 1 << 64), CHUNK + 1)])
    return _POW


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column end to end and its n + 1 offsets (null: empty)."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0]: at[-1]], at - at[0]


class Words(NamedTuple):
    """Words of a batch in order: row number, byte span in the batch, hash."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


def word_spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of other bytes inside each text."""
    inside = ~separator[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]  # a text's words end with it
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of ascending byte spans that do not overlap; lower case and upper case A-Z are equal."""
    power, inverse = _power_tables()
    out = np.empty(len(start), U64)
    k = 0
    with np.errstate(over="ignore"):
        while k < len(start):
            lo = int(start[k])
            n = int(np.searchsorted(end, lo + CHUNK, side="right")) - k
            if n == 0:  # one word longer than a chunk
                h = U64(0)
                for at in range(lo, int(end[k]), CHUNK):
                    part = data[at: min(at + CHUNK, int(end[k]))]
                    h = mix(np.array([h + (BYTE_VALUE[part] * power[: len(part)]).sum(dtype=U64)], U64), 3)[0]
                out[k] = h
                k += 1
                continue
            s, e = start[k: k + n] - lo, end[k: k + n] - lo
            part = data[lo: lo + int(e[-1])]
            sums = np.zeros(len(part) + 1, U64)
            np.cumsum(BYTE_VALUE[part] * power[: len(part)], out=sums[1:])
            out[k: k + n] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(U64), 1)
            k += n
    return out


def words_of(column: pa.Array, separator: np.ndarray = SPACE) -> Words:
    data, offsets = text_bytes(column)
    start, end = word_spans(data, offsets, separator)
    row = np.searchsorted(offsets, start, side="right") - 1
    return Words(row, start, end, span_hashes(data, start, end))


def shingle_hashes(words: np.ndarray, row: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and rows of all ``size``-word shingles that lie in one text."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    h = np.zeros(n, U64)
    with np.errstate(over="ignore"):
        for k in range(size):
            h = h * U64(BASE) + words[k: k + n]
    whole = row[:n] == row[size - 1:]
    return mix(h[whole], 2), row[:n][whole]


def release() -> None:
    """Give freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def give_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task function after which freed memory goes back to the system.

    Python workers serve one task after the other; without this each keeps the most that any
    of its tasks has held, beside what the executor itself holds.
    """
    @wraps(run)
    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            release()
    return task


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 2 << 20,
           max_rows: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in runs of at most ``max_bytes`` of text and ``max_rows`` rows (one row at least)."""
    for batch in batches:
        size = np.diff(text_bytes(batch.column(column))[1])
        lo = 0
        while lo < batch.num_rows:
            n = min(max_rows, max(1, int(np.searchsorted(np.cumsum(size[lo: lo + max_rows]), max_bytes, side="right"))))
            yield batch.slice(lo, n)
            lo += n
