"""Words and shingles of whole Arrow string columns as 64-bit hashes, computed on byte buffers.

A word is a run of bytes outside 0x20 and 0x09-0x0D. A word's hash mixes its 8-byte pieces, each with its place, by a bijection without
algebraic structure, so that structured words don't collide as they do under polynomials; words of up to 8 bytes of one length never do. Where a result
depends on equality, callers compare words or bytes as well. All constants are fixed, so that every worker and every run agrees. Work is done in slabs
of bytes; a long text only costs 8 bytes a word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SLAB = 1 << 20
U64 = np.uint64
WORD_RE = r"[^\x20\x09-\x0D]+"
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_P = U64(0x9E3779B97F4A7C15)
_Q = U64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def column(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets if len(offsets) else np.zeros(1, np.int64)


def slices(batch: pa.RecordBatch, name: str, rows: int, size: int):
    """A batch in slices of at most so many rows and so many bytes of a string column; a longer text is a slice of its own."""
    _, offsets = column(batch.column(name))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
        to = min(max(to, at + 1), at + rows, batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def word_spans(data: np.ndarray, offsets: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in data[lo:hi]; lo and hi don't lie within a word."""
    on = ~_SPACE[data[lo:hi]]
    first = on.copy()
    first[1:] &= ~on[:-1]
    last = on.copy()
    last[:-1] &= ~on[1:]
    cuts = offsets[np.searchsorted(offsets, lo, "right") : np.searchsorted(offsets, hi, "left")] - lo
    cuts = cuts[(cuts > 0) & (cuts < hi - lo)]
    first[cuts] = on[cuts]
    last[cuts - 1] = on[cuts - 1]
    return np.flatnonzero(first) + lo, np.flatnonzero(last) + (lo + 1)


def _slabs(data: np.ndarray, offsets: np.ndarray):
    lo, end = int(offsets[0]), int(offsets[-1])
    while lo < end:
        hi = min(lo + SLAB, end)
        stop = int(offsets[np.searchsorted(offsets, hi, "left")])
        while hi < stop:  # on to the next space, or the end of this text
            found = np.flatnonzero(_SPACE[data[hi : min(hi + 65536, stop)]])
            if len(found):
                hi += int(found[0])
                break
            hi = min(hi + 65536, stop)
        yield lo, hi
        lo = hi


def padded(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A copy of ``data`` with room behind it, and the 64-bit number at each of its bytes."""
    buf = np.zeros(len(data) + 16, np.uint8)
    buf[: len(data)] = data
    return buf, numbers(buf)


def numbers(buf: np.ndarray) -> np.ndarray:
    """The 64-bit little-endian number at each byte of ``buf`` but the last seven."""
    return np.ndarray((max(0, len(buf) - 7),), "<u8", buf, strides=(1,))


def tails(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the spans of over 8 bytes: their places, and for each further 8 bytes its span (a place among those), its number and its first byte."""
    n = (ends - starts - 1) >> 3
    long = np.flatnonzero(n > 0)
    n = n[long]
    owner = np.repeat(np.arange(len(long)), n)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + 1
    return long, owner, k, starts[long][owner] + 8 * k


def first_numbers(view: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The first 8 bytes of each span as a number; what lies behind a span's end is zero."""
    return view[starts] & _MASK[np.minimum(ends - starts, 8)]


def span_hashes(view: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans [start, end), none empty, in a buffer of ``padded``."""
    lens = ends - starts
    with np.errstate(over="ignore"):
        h = mix(first_numbers(view, starts, ends) ^ _P)
        long, owner, k, at = tails(starts, ends)
        if len(long):
            part = mix((view[at] & _MASK[np.minimum(ends[long][owner] - at, 8)]) ^ mix(k.astype(np.uint64) * _Q))
            h[long] += np.add.reduceat(part, np.flatnonzero(k == 1))
        return mix(h + lens.astype(np.uint64) * _Q)


def same_spans(view: np.ndarray, starts: np.ndarray, ends: np.ndarray, view2: np.ndarray, starts2: np.ndarray, ends2: np.ndarray) -> np.ndarray:
    """Whether each span has the same bytes as its partner."""
    same = ends - starts == ends2 - starts2
    same &= first_numbers(view, starts, ends) == first_numbers(view2, starts2, ends2)
    at = np.flatnonzero(same)
    long, owner, _, place = tails(starts[at], ends[at])
    if len(long):
        at = at[long]
        mask = _MASK[np.minimum(ends[at][owner] - place, 8)]
        other = starts2[at][owner] + place - starts[at][owner]
        same[at[owner[(view[place] ^ view2[other]) & mask != 0]]] = False
    return same


def words_of(arr: pa.Array, lower: bool):
    """Slabs of a column: each slab's ``padded`` buffer and numbers, and where its words start and end there, in row order; then the place of the slab in the column's bytes."""
    data, offsets = column(arr)
    for lo, hi in _slabs(data, offsets):
        s, e = word_spans(data, offsets, lo, hi)
        if len(s):
            part = data[lo:hi]
            yield *padded(_LOWER[part] if lower else part), s - lo, e - lo, lo


def word_hashes(arr: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in row order, and the bounds of each row's words in them."""
    _, offsets = column(arr)
    hashes, starts = [], []
    for _, view, s, e, lo in words_of(arr, lower):
        hashes.append(span_hashes(view, s, e))
        starts.append(s + lo)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    starts = np.concatenate(starts)
    return np.concatenate(hashes), np.searchsorted(starts, offsets, "left")


class Words:
    """All words of a column at once: their bytes (``buf``, ``view``, ``starts``, ``ends``), their hashes ``w``, and the bounds of each row's words."""

    def __init__(self, arr: pa.Array, lower: bool):
        data, offsets = column(arr)
        lo, hi = int(offsets[0]), int(offsets[-1])
        data, self.offsets = data[lo:hi], offsets - lo
        self.buf, self.view = padded(_LOWER[data] if lower else data)
        self.starts, self.ends = word_spans(data, self.offsets, 0, hi - lo) if hi > lo else (np.zeros(0, np.int64),) * 2
        self.w = span_hashes(self.view, self.starts, self.ends)
        self.bounds = np.searchsorted(self.starts, self.offsets, "left")

    def lists(self) -> list[list[bytes]]:
        """The words themselves, by row."""
        return [self.buf[a:b].tobytes().split() for a, b in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist())]

    def spelled(self) -> tuple[np.ndarray, np.ndarray]:
        """All words, each with one space behind it, in a row, and where each begins there (one more: the end)."""
        stop = np.concatenate([[0], np.cumsum(self.ends - self.starts + 1)])
        out = np.full(int(stop[-1]), 0x20, np.uint8)
        on = np.ones(len(out), bool)
        on[stop[1:] - 1] = False
        inside = np.zeros(len(self.buf) + 1, np.int8)
        inside[self.starts] = 1
        inside[self.ends] -= 1
        out[on] = self.buf[np.cumsum(inside[:-1], dtype=np.int8).view(bool)]
        return out, stop

    def sound(self) -> bool:
        """Whether equal hashes are equal words."""
        order = np.argsort(self.w)
        twin = np.flatnonzero(self.w[order[1:]] == self.w[order[:-1]])
        a, b = order[twin], order[twin + 1]
        return bool(same_spans(self.view, self.starts[a], self.ends[a], self.view, self.starts[b], self.ends[b]).all())

    def sound_sequences(self, hashes: np.ndarray, k: int) -> bool:
        """Whether equal ones of ``hashes`` (of ``sequences``) are of equal words; the words' own hashes are sound."""
        order = np.argsort(hashes)
        twin = np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]])
        a, b = order[twin], order[twin + 1]
        return all((self.w[a + j] == self.w[b + j]).all() for j in range(k))


def sequences(w: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive hashes, whatever rows they lie in."""
    n = len(w) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        acc = w[:n].copy()
        for j in range(1, k):
            acc *= _Q
            acc += w[j : j + n]
    return mix(acc)


def shingles(w: np.ndarray, bounds: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its k-word shingles; of fewer words, one of the whole."""
    every = sequences(w, k)
    out = []
    with np.errstate(over="ignore"):
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= k:
                out.append(np.unique(every[a : b - k + 1]))
            elif b > a:
                out.append(sequences(w[a:b], b - a) + U64(b - a))
            else:
                out.append(np.zeros(0, np.uint64))
    return out
