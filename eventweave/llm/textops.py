"""Vectorised helpers over UTF-8 columns, used inside Arrow tasks.

A text column arrives as one byte buffer with row offsets. Words are maximal runs of bytes
outside ``[\\x20\\x09-\\x0D]``; they are found and hashed with numpy over the buffer, a
bounded slice at a time, so a task's memory does not depend on the length of a text beyond
a few machine words per word of it. Nothing here knows about Spark plans.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U = np.uint64

# Arrays of some hundred KB come and go with every block. By default the C library grows its
# heap for them and gives little back; mapped on their own they are returned when freed.
_M_MMAP_THRESHOLD = -3
with contextlib.suppress(OSError, AttributeError):
    ctypes.CDLL(None).mallopt(_M_MMAP_THRESHOLD, 128 << 10)

#: Bytes of text hashed in one numpy pass.
SLICE = 1 << 18
#: Bytes of text handled as one block of rows.
BLOCK = 4 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_MUL = U(0x9E3779B97F4A7C15 | 1)
_INV = U(pow(int(_MUL), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}

#: Tables that a worker keeps between tasks of one kind; tasks of another kind drop them, as a
#: worker goes on from stage to stage.
WORKER_TABLES: list[dict] = []


def drop_worker_tables() -> None:
    for table in WORKER_TABLES:
        table.clear()


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """1, m, m^2, ... modulo 2^64 (of the odd multiplier, or of its inverse)."""
    key = "inv" if inverse else "mul"
    have = _powers.get(key)
    if have is None or len(have) < n:
        p = np.full(max(n, SLICE + 64), _INV if inverse else _MUL, dtype=np.uint64)
        p[0] = 1
        np.cumprod(p, out=p)
        if len(p) > 8 * SLICE:
            return p[:n]            # a huge text: not kept
        _powers[key] = have = p
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


_ALL = U(0xFFFFFFFFFFFFFFFF)
#: Spans of more bytes are hashed one by one.
LONG = 64


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on, as little-endian integers (zeros after the end)."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    return np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))


def _lane(view: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Up to eight bytes from ``at`` on, those beyond ``left`` as zeros."""
    return view[at] & (_ALL >> ((8 - np.minimum(left, 8)) * 8).astype(np.uint64))


def byte_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes ``data[start:end]`` of many spans, eight bytes a step. Every
    step is a bijection of those bytes, so spans of one length up to eight never share a hash;
    others do as often as random numbers."""
    n = end - start
    h = n.astype(np.uint64) * U(0xD6E8FEB86659FD93) ^ U(0x2545F4914F6CDD1D)
    if len(n) and len(data):
        view, own = eights(data), np.arange(len(n))
        for i in range(0, LONG, 8):
            own = own[(n[own] > i) & (n[own] <= LONG)]
            if not len(own):
                break
            k = _lane(view, start[own] + i, n[own] - i) * U(0x87C37B91114253D5)
            k = ((k << U(31)) | (k >> U(33))) * U(0x4CF5AD432745937F)
            g = h[own] ^ k
            h[own] = ((g << U(27)) | (g >> U(37))) * U(5) + U(0x52DCE729)
        for i in np.flatnonzero(n > LONG).tolist():
            h[i] = xxhash.xxh64_intdigest(data[start[i]:end[i]].tobytes(), int(n[i]) & 0xFFFFFFFF)
    return mix(h)


def same_bytes(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, n: np.ndarray,
               left: np.ndarray | None = None, right: np.ndarray | None = None) -> np.ndarray:
    """Whether ``a[a_at:a_at + n]`` and ``b[b_at:b_at + n]`` are the same bytes, for many spans;
    ``left`` and ``right`` are their ``eights``, if the caller has them."""
    same = np.ones(len(n), bool)
    if not len(n) or not len(a) or not len(b):
        return same
    left, right = eights(a) if left is None else left, eights(b) if right is None else right
    own, at = np.arange(len(n)), 0
    while len(own := own[same[own] & (n[own] > at)]):
        if at >= LONG:          # long ones: few, whole
            for i in own.tolist():
                same[i] = a[a_at[i] + at:a_at[i] + n[i]].tobytes() == b[b_at[i] + at:b_at[i] + n[i]].tobytes()
            break
        same[own] = _lane(left, a_at[own] + at, n[own] - at) == _lane(right, b_at[own] + at, n[own] - at)
        at += 8
    return same


def span_hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``codes[start:end]`` for many spans of at most some dozens of symbols;
    ``codes`` are hashes themselves (a polynomial of plain bytes would not tell all spans apart)."""
    n = len(codes)
    c = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(codes * powers(n), out=c[1:])
    h = (c[end] - c[start]) * powers(n + 1, inverse=True)[start]
    return mix(h ^ ((end - start).astype(np.uint64) * U(0xD6E8FEB86659FD93)))


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all windows of ``k`` consecutive symbols (an empty array if too few)."""
    if len(words) < k:
        return np.zeros(0, dtype=np.uint64)
    i = np.arange(len(words) - k + 1)
    return span_hashes(words, i, i + k)


@dataclass
class Words:
    """Words of a block of rows: byte spans in ``data``, hash and row of each; ``first[r]``
    is the index of row r's first word (one more entry than rows)."""
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    row: np.ndarray
    first: np.ndarray


def column_bytes(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, dtype=np.int64, count=n + 1, offset=col.offset * 8)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    lo, hi = int(offsets[0]), int(offsets[-1])
    return np.frombuffer(data, dtype=np.uint8, count=hi)[lo:], offsets - lo


def blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of rows of at most ``limit`` bytes of text (or one row)."""
    _, off = column_bytes(batch.column(column))
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield batch.slice(i, min(j, n) - i)
        i = min(j, n)


def _edges(space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    padded = np.ones(len(space) + 2, dtype=bool)
    padded[1:-1] = space
    flip = np.flatnonzero(padded[1:] != padded[:-1])
    return flip[0::2], flip[1::2]


def split_words(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = SPACE, fold: np.ndarray | None = None) -> Words:
    """Words of every row of a block. Rows are kept apart although their bytes touch.
    ``apart``: the bytes between words; ``fold``: the byte that a word's hash takes for each byte."""
    n = len(data)
    starts, ends, hashes = [], [], []
    pos = 0
    while pos < n:
        stop = min(pos + SLICE, n)
        if stop < n:
            # cut where a word cannot run on: after the last space, or at a row's start
            near = np.flatnonzero(apart[data[pos:stop]])
            cut = int(near[-1]) + pos + 1 if len(near) else pos
            r = int(np.searchsorted(offsets, stop, side="right")) - 1
            cut = max(cut, int(offsets[r])) if offsets[r] > pos else cut
            if cut <= pos:          # one word longer than a slice
                rest = np.flatnonzero(apart[data[stop:int(offsets[r + 1])]])
                cut = stop + int(rest[0]) if len(rest) else int(offsets[r + 1])
            stop = cut
        part = data[pos:stop]
        space = apart[part]
        s, e = _edges(space)
        inner = offsets[(offsets > pos) & (offsets < stop)] - pos
        if len(inner) and len(s):   # words of neighbouring rows that touch
            inner = np.unique(inner)
            w = np.searchsorted(s, inner, side="right") - 1
            ok = (w >= 0) & (inner < e[np.maximum(w, 0)]) & (inner > s[np.maximum(w, 0)])
            inner = inner[ok]
            if len(inner):
                s = np.sort(np.concatenate([s, inner]))
                e = np.sort(np.concatenate([e, inner]))
        if len(s):
            hashes.append(byte_hashes(part if fold is None else fold[part], s, e))
            starts.append(s + pos)
            ends.append(e + pos)
        pos = stop
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    end = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, start, end, h, row, first)


def windows_in_rows(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all windows of k words, mask of those that lie in one row)."""
    h = window_hashes(w.hash, k)
    if not len(h):
        return h, np.zeros(0, bool)
    return h, w.row[: len(h)] == w.row[k - 1:]


def per_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over ``[first[r], first[r+1])`` for every row r."""
    c = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=c[1:])
    return c[first[1:]] - c[first[:-1]]


def per_row_float(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The same for doubles; each row is summed for itself, so rows do not touch each other."""
    out = np.zeros(len(first) - 1)
    some = np.diff(first) > 0
    if some.any():
        out[some] = np.add.reduceat(values.astype(float), first[:-1][some])
    return out


def ordered(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Stable order by two keys."""
    return np.lexsort((second, first))


def repeated_in_row(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks over entries (row, h): the value occurs twice or more in its row; it occurred
    earlier in its row (entries stand in order of their position)."""
    twice, later = np.zeros(len(h), bool), np.zeros(len(h), bool)
    if len(h):
        o = ordered(row, h)
        same = (row[o][1:] == row[o][:-1]) & (h[o][1:] == h[o][:-1])
        later[o[1:][same]] = True
        twice[o[1:][same]] = True
        twice[o[:-1][same]] = True
    return twice, later


def covered(n: int, at: np.ndarray, length: int) -> np.ndarray:
    """Mask of the n positions covered by ``[a, a + length)`` for any a in ``at``."""
    d = np.zeros(n + 1, dtype=np.int32)
    np.add.at(d, at, 1) if len(at) < 32 else d.__iadd__(np.bincount(at, minlength=n + 1).astype(np.int32)[: n + 1])
    stop = np.minimum(at + length, n)
    d -= np.bincount(stop, minlength=n + 1).astype(np.int32)[: n + 1]
    return np.cumsum(d[:-1]) > 0
