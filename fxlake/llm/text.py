"""Vectorised text helpers for Arrow batches.

A batch is worked through in slices of about ``SLICE_BYTES`` of text, so a task
holds a few arrays of that size whatever the batch holds; one text is never cut.
Words, lines and windows are found with byte masks on the UTF-8 buffer. Words
and windows carry 64-bit polynomial hashes (taken from prefix sums, then mixed).
"""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18

U64 = np.uint64

ROWS_PER_BATCH = 1000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark) -> None:
    """Lower the session's rows per Arrow batch: the default of 10,000 means tens of MB of text in each buffer of each task."""
    if not 0 < int(spark.conf.get(_ROWS)) <= ROWS_PER_BATCH:
        spark.conf.set(_ROWS, str(ROWS_PER_BATCH))

_P, _Q = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: words [^\x20\x09-\x0D]+
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
ALNUM = np.ones(256, bool)
ALNUM[:0x80] = False
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True


def released(work: Callable) -> Callable:
    """``work`` on a task's batches; what it leaves unused goes back to the system, as workers are kept for later tasks."""
    @functools.wraps(work)
    def run(*args):
        try:
            yield from work(*args)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)
    return run


def _pow(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse modulo 2^64, at least ``n`` of each."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, n + n // 4)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, U64(b))
            p[0] = 1
            out.append(np.cumprod(p, dtype=U64))
        have = _powers[base] = (out[0], out[1])
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: nearby inputs get unrelated outputs."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _P) -> np.ndarray:
    """A hash of values[start:end] for every span."""
    up, down = _pow(base, len(values) + 1)
    total = np.zeros(len(values) + 1, U64)
    np.cumsum((values.astype(U64) + U64(1)) * up[: len(values)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix(h + (ends - starts).astype(U64) * U64(_Q))


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, in pieces of about ``limit`` bytes of ``column``."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.diff(buffer(batch.column(batch.schema.get_field_index(column)))[1])
        at = 0
        total = np.cumsum(sizes)
        while at < batch.num_rows:
            before = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all values behind each other, and where each begins (nulls are empty)."""
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type)
    bufs = col.buffers()
    if bufs[1] is None or len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offsets = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


class Words:
    """The words of a column: byte spans, hashes and, per text, the range of its words."""

    def __init__(self, col: pa.Array, table: np.ndarray, lower: bool = True):
        raw, self.offsets = buffer(col)
        self.data = LOWER[raw] if lower else raw
        n = len(self.data)
        mask = table[self.data]
        first = np.zeros(n + 1, bool)
        first[self.offsets] = True
        begins = mask.copy()
        begins[1:] &= ~mask[:-1] | first[1:n]
        stops = mask.copy()
        stops[:-1] &= ~mask[1:] | first[1:n]
        self.mask = mask
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(stops) + 1
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self._hashes = None

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = span_hashes(self.data, self.starts, self.ends)
        return self._hashes

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of ``n`` words of one text, and the windows' hashes."""
        end = np.repeat(self.bounds[1:], self.counts)
        at = np.flatnonzero(np.arange(len(end)) + n <= end)
        return at, span_hashes(self.hashes, at, at + n, _Q)

    def compact(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words joined by single spaces as bytes, and where each word begins and ends there."""
        sizes = self.ends - self.starts
        ends = np.cumsum(sizes + 1) - 1
        starts = ends - sizes
        out = np.full(int(ends[-1]) + 1 if len(ends) else 0, 0x20, np.uint8)
        word = np.repeat(np.arange(len(sizes)), sizes)
        out[np.arange(len(word)) + word] = self.data[self.mask]
        return out, starts, ends


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over each range of ``bounds``."""
    total = np.zeros(len(values) + 1, values.dtype if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
