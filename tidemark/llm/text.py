"""Vectorised helpers on Arrow string columns, used inside ``mapInArrow`` tasks.

A null text counts as an empty one everywhere.  Words are maximal runs of bytes other than
0x20 and 0x09-0x0D; UTF-8 continuation bytes never equal one of these, so splitting bytes is exact.
"""

from __future__ import annotations

import ctypes
import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SEP = np.zeros(256, bool)
SEP[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> U(32))
    h = h * U(0x9E3779B97F4A7C15)
    h ^= h >> U(29)
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(32)
    return h


_TAB = mix(np.arange(1, 32 * 256 + 1, dtype=U) * U(0x9E3779B97F4A7C15))


def slices(batches, column: str = "text", max_bytes: int = 2 << 20):
    """Cut record batches so that each piece holds about ``max_bytes`` of text (or one document)."""
    for b in batches:
        if not b.num_rows:
            continue
        n = pc.fill_null(pc.binary_length(b.column(b.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
        cum, at = np.cumsum(n, dtype=np.int64), 0
        while at < b.num_rows:
            base = cum[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(cum, base + max_bytes, side="right")))
            yield b.slice(at, to - at)
            at = to


@functools.cache
def _trim():
    """The C library's call that gives free memory back, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Gives the worker's free memory back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def tidied(f):
    """f, a function of one or two groups, with free memory given back before and after each call."""

    def one(group):
        release()
        out = f(group)
        release()
        return out

    def two(left, right):
        release()
        out = f(left, right)
        release()
        return out

    return one if f.__code__.co_argcount == 1 else two


def tidy(batches):
    """The same batches; what the worker's earlier tasks left goes back to the system first, and what this one left at its end.

    Workers serve one stage after the other, and the C library keeps the pages of freed arrays: some 100 MB a worker.
    """
    release()
    yield from batches
    release()


def raw(b: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows in them."""
    a = b.column(b.schema.get_field_index(column))
    a = pc.fill_null(a, "") if a.null_count else a
    kind = np.int64 if pa.types.is_large_string(a.type) or pa.types.is_large_binary(a.type) else np.int32
    _, off, data = a.buffers()
    offs = np.frombuffer(off, kind)[a.offset : a.offset + len(a) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None and len(offs) else np.zeros(0, np.uint8)
    return buf, offs - offs[0]


def words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each row the number of words before it (one more at the end)."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    w = ~SEP[buf]
    before = np.zeros(n + 1, bool)
    before[1:] = w
    before[offs] = False  # a row's first byte follows nothing
    after = np.zeros(n + 1, bool)
    after[:n] = w
    after[offs] = False
    starts = np.flatnonzero(w & ~before[:n])
    ends = np.flatnonzero(w & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit tabulation hash of each word's bytes and length."""
    if not len(starts):
        return np.zeros(0, U)
    lens = ends - starts
    first = np.concatenate(([0], np.cumsum(lens)[:-1]))
    pos = np.arange(int(lens.sum())) - np.repeat(first, lens)
    v = _TAB[((pos & 31) << 8) | buf[np.repeat(starts, lens) + pos]]
    if lens.max() > 32:
        v = v * ((pos >> 5).astype(U) * U(0x2545F4914F6CDD1D) * U(2) + U(1))
    return mix(np.add.reduceat(v, first) ^ (lens.astype(U) * U(0xD6E8FEB86659FD93)))


def rows_of(offs: np.ndarray) -> np.ndarray:
    """The row of each element."""
    return np.repeat(np.arange(len(offs) - 1), np.diff(offs))


def longs(h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(h).view(np.int64)
