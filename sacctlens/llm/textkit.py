"""Per-task text helpers: Arrow batches to byte buffers, word spans and hashes.

A word is a maximal run of bytes other than space and 0x09-0x0D; these bytes are
ASCII, so splitting UTF-8 bytes equals splitting code points.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes that one numpy step works on; a longer single text is one step.
STEP_BYTES = 4 << 20
#: The same for steps that hold some ten times their text.
SMALL_STEP = 1 << 20

#: Bytes that separate words.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xD6E8FEB86659FD93)
_S32 = np.uint64(32)
_S29 = np.uint64(29)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> _S32)
    x = x * _M2
    x = x ^ (x >> _S29)
    x = x * _M1
    return x ^ (x >> _S32)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets (n + 1) of a string column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offs = np.frombuffer(off, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def steps(batch: pa.RecordBatch, text: str = "text", most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch that hold about ``most`` bytes of text each."""
    lens = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(lens)
    lo, n = 0, len(lens)
    while lo < n:
        base = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, base + most, side="right")))
        yield lo, hi
        lo = hi


def give_back() -> None:
    """What this process has freed goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.pythonapi, "malloc_trim", None)  # glibc's; others need no call or have none
    if trim is not None:
        trim(0)


def lean(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The same task function, after which the worker keeps nothing it has freed.

    Spark's Python workers outlive their tasks, and what they hold counts beside the executor's heap.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def word_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the word offsets (n + 1) of the rows."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    solid = ~SPACE[buf]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    lo, hi = offs[:-1], offs[1:]
    full = hi > lo
    first[lo[full]] = solid[lo[full]]
    last[hi[full] - 1] = solid[hi[full] - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offs)


_MASK = np.array([0] + [(1 << (8 * k)) - 1 for k in range(1, 9)], dtype=np.uint64)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each byte span, read eight bytes at a time."""
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[:len(buf)] = buf
    eight = np.ndarray(shape=(len(buf) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    size = ends - starts
    h = mix(size.astype(np.uint64) + np.uint64((seed * int(_M1) + int(_M2)) % (1 << 64)))
    if not len(h):
        return h
    h = mix(h ^ (eight[starts] & _MASK[np.minimum(size, 8)]))
    more, at = np.flatnonzero(size > 8), 8
    while len(more):
        h[more] = mix(h[more] ^ (eight[starts[more] + at] & _MASK[np.minimum(size[more] - at, 8)]))
        at += 8
        more = more[size[more] > at]
    return h


def record(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type) for f in schema], schema=schema)


def blobs(chunks) -> pa.Array:
    """A binary column of byte strings."""
    return pa.array([bytes(c) for c in chunks], pa.binary())
