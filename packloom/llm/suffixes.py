"""Substring dedup on a suffix array, sorted by a distributed difference-cover algorithm: bytes of repeated strings of ``length`` bytes are cut.

1. Candidates. Texts lie in packs, in order of (doc_id, text hash). Each window of ``length`` bytes has an anchor, the ``GRAM``-byte string in it that a hash ranks first;
   equal windows have equal anchors. Windows whose anchor occurs once in the corpus can't repeat and leave the sort. Of equal windows of
   one pack (compared byte for byte) only the first one stays, the others are settled: a passage in a third of all documents costs a row a pack.
2. Sampled triples. Of the suffixes that begin in what is left, those are sampled whose place has no zero among its last two base-3 digits: the sample of the sample of
   the difference cover {1, 2} modulo 3, four in nine. Bytes are packed into words that sort like them; sorting three triples of triples of bytes (27 bytes) names each sampled place.
3. Recursion on names. Sampled suffixes are sorted by sequences of such names, which tell as many bytes as a window can have behind a sampled place.
4. Merging. Any two places are followed within nine bytes by two sampled ones at equal distance. The remaining suffixes are ordered by the bytes before the sampled suffix behind them and that one's rank,
   for each distance that two suffixes can share. Neighbours in that order are compared over the whole window: the smallest place of each run of equals stays, the windows
   at the others are removed.

Sorting goes by ranges of words: tasks split what they have into the ranges' blocks of arrays, Spark deals these out, a task sorts a range. Ranges are cut by a bounded sample, which
changes no result; equal words are in one range, whose size the settling of equal windows of a pack bounds. Large inputs are sorted in passes over the ranges, so that scratch space stays in proportion to the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packloom.llm import _text
from packloom.llm._store import alone, remove_dir, table
from packloom.ship import ship

LENGTH, GRAM = 100, 32
#: Bytes of text in a pack; longer texts are cut into parts that overlap.
PACK_BYTES = 4 << 20
#: Sampled places in a range of the sort, and in all that its cuts are taken from.
RANGE_ROWS, CUT_ROWS = 1 << 19, 1 << 17
#: Bytes that a sampled place takes in the widest shuffle, and the share of the texts' bytes that one pass may shuffle.
PLACE_BYTES, PASS_SHARE = 40, 0.8
#: Bytes hashed at once.
SLAB = 1 << 16
#: The cover's period, the most that a sampled place lies behind any other, and the bytes of a name.
PERIOD, NAME = 9, 27
_LAST = 2**63 - 1
_U = np.uint64
_P, _Q = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)
PACK = "docs array<long>, ths array<long>, begins array<long>, starts array<int>, owns array<int>, text binary"
STATE = "id long, docs array<long>, ths array<long>, begins array<long>, starts array<int>, text binary, froms array<int>, lens array<int>, valid binary"
_COVER = np.array([i % 3 != 0 and (i // 3) % 3 != 0 for i in range(PERIOD)])


def _binary(*arrays: np.ndarray) -> pa.Array:
    return pa.array([np.ascontiguousarray(a).tobytes() for a in arrays], pa.binary())


def _ints(column: pa.Array, row: int, kind=np.int64) -> np.ndarray:
    return np.asarray(column[row].values).astype(kind)


def _numbers(column: pa.Array, row: int, kind) -> np.ndarray:
    buf = column[row].as_buffer()
    return np.frombuffer(buf, kind) if buf is not None and buf.size else np.zeros(0, kind)


def _packed(a: np.ndarray) -> bytes:
    """Numbers as the bytes that the largest of them needs, byte by byte."""
    width = max(1, (int(a.max()).bit_length() + 7) // 8) if len(a) else 1
    raw, out = a.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8), np.empty((width, len(a)), np.uint8)
    for i in range(width):
        out[i] = raw[:, i]
    return bytes([width]) + out.tobytes()


def _unpacked(x: pa.Scalar) -> np.ndarray:
    raw = np.frombuffer(x.as_buffer(), np.uint8)
    width = int(raw[0])
    out = np.zeros(((len(raw) - 1) // width, 8), np.uint8)
    for i, one in enumerate(raw[1:].reshape(width, -1)):  # faster than the whole, transposed
        out[:, i] = one
    return out.view("<u8").ravel()


# ---- packs


def _parts(batches: Iterator[pa.RecordBatch], length: int, size: int) -> Iterator[pa.RecordBatch]:
    """Packs of whole texts, a longer text in parts: of each part its doc, th, place in its text, place in the pack and number of windows that begin in it."""
    held, text, last = [], [], None

    def pack() -> pa.RecordBatch:
        cols = [pa.array([list(c)], t) for c, t in zip(zip(*held), (pa.list_(pa.int64()),) * 3 + (pa.list_(pa.int32()),) * 2)]
        return pa.RecordBatch.from_arrays([*cols, pa.array([b"".join(text)], pa.binary())], names=[x.split()[0] for x in PACK.split(", ")])

    at = 0
    for batch in batches:
        docs, ths, texts = (batch.column(c) for c in ("doc", "th", "text"))
        for i in range(batch.num_rows):
            key = docs[i].as_py(), ths[i].as_py()
            if key == last:
                continue  # a row of the same doc_id and text
            last, raw = key, texts[i].as_buffer()
            for a in range(0, raw.size - length + 1, size):
                own = min(size, raw.size - length + 1 - a)
                if held and at + own > size:
                    yield pack()
                    held, text, at = [], [], 0
                held.append((*key, a, at, own))
                text.append(raw.slice(a, own + length - 1))
                at += own + length - 1
    if held:
        yield pack()


def _hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes at each place."""
    n = max(0, len(data) - GRAM + 1)
    out = np.empty(n, np.uint64)
    buf = np.zeros(len(data) + 16, np.uint8)
    buf[: len(data)] = data
    view = _text.numbers(buf)
    for a in range(0, n, SLAB):
        b = min(a + SLAB, n)
        h = _text.mix(view[a : b + GRAM - 8] ^ _P)
        with np.errstate(over="ignore"):
            two = h[:-8] * _Q
            two += h[8:]
            four = np.multiply(two[: b - a], _P, out=h[: b - a])
            four += two[16 : 16 + b - a]
            np.right_shift(four, _U(29), out=out[a:b])
            out[a:b] ^= four
    return out


def _pieces(a: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Slices of an array, one behind the other."""
    return np.concatenate([a[:0], *[a[b : b + n] for b, n in zip(begins.tolist(), sizes.tolist())]])


def _distinct(key: np.ndarray) -> np.ndarray:
    """Distinct numbers in ascending order, by one sort (``np.unique`` takes a hash table, which is slower)."""
    key = np.sort(key)
    return key[np.concatenate([[True], key[1:] != key[:-1]])[: len(key)]]


def _anchors(grams: np.ndarray, length: int) -> np.ndarray:
    """The place of the anchor of the window at each place."""
    width = length - GRAM + 1
    n = max(0, len(grams) - width + 1)
    out = np.empty(n, np.uint32)
    step = np.arange(min(SLAB, n) + width - 1, dtype=np.uint64)
    for a in range(0, n, SLAB):
        b = min(a + SLAB, n)
        with np.errstate(over="ignore"):
            low = grams[a : b + width - 1] * _Q
        low &= ~_U(0xFFFFFFFF)
        low |= step[: len(low)]  # ties by place: the first
        size = 1
        while size * 2 <= width:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        out[a:b] = np.minimum(low[: b - a], low[width - size : width - size + b - a])  # its low half
        out[a:b] += np.uint32(a)
    return out


def _keys(data: np.ndarray, starts: np.ndarray, owns: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Of all windows of a pack, in order: their runs of one anchor (the first of each, and how many), and the anchors' hashes; and the hashes of all GRAM-byte strings."""
    grams = _hashes(data)
    anchor = _pieces(_anchors(grams, length), starts, owns)
    heads = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    return heads, np.diff(np.append(heads, len(anchor))), _text.mix(grams[anchor[heads]]), grams


def _among(key: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Whether each is one of some sorted ones."""
    return some[np.minimum(np.searchsorted(some, key), len(some) - 1)] == key if len(some) else np.zeros(len(key), bool)


def _anchor_rows(batches: Iterator[pa.RecordBatch], length: int, ranges: int) -> Iterator[pa.RecordBatch]:
    """The distinct anchors of each pack, in blocks by ranges of their hashes."""
    for batch in batches:
        for i in range(batch.num_rows):
            key = _distinct(_keys(_numbers(batch.column("text"), i, np.uint8), _ints(batch.column("starts"), i), _ints(batch.column("owns"), i), length)[2])
            bucket = (key >> _U(40)).astype(np.int64) * ranges >> 24
            cuts = np.searchsorted(bucket, np.arange(ranges + 1))
            some = np.flatnonzero(np.diff(cuts))
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(np.full(len(some), batch.column("id")[i].as_py())), _binary(*[key[cuts[b] : cuts[b + 1]] for b in some])], names=["bucket", "id", "keys"])


def _shared(rows: pa.Table) -> pa.Table:
    """Of the anchors of one range, those of several packs, for each pack."""
    ids, blocks = rows.column("id").to_numpy(), [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("keys")]
    key = np.concatenate(blocks)
    order = np.argsort(key, kind="stable")
    twin = key[order[1:]] == key[order[:-1]]
    on = np.zeros(len(key), bool)
    on[order[1:][twin]] = on[order[:-1][twin]] = True
    ends = np.cumsum([len(b) for b in blocks])
    kept = [b[on[e - len(b) : e]] for b, e in zip(blocks, ends)]
    return pa.table({"id": pa.array(ids), "keys": _binary(*kept)}).filter(pa.array([len(k) > 0 for k in kept]))


def _same(buf: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the windows at ``a`` and ``b`` have the same bytes."""
    view, same = _text.numbers(buf), np.ones(len(a), bool)
    for k in [*range(0, length - 7, 8), length - 8]:
        same &= view[a + k] == view[b + k]
    return same


def _alike(raw: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the windows at ``a`` and ``b`` have the same bytes. Windows that follow one another on both sides are compared as one string, those of unequal strings one by one."""
    heads = np.flatnonzero(np.concatenate([[True], (a[1:] - a[:-1] != 1) | (b[1:] - b[:-1] != 1)])[: len(a)])
    size = np.diff(np.append(heads, len(a)))
    text = raw.tobytes()
    same = np.repeat(np.array([text[i : i + n] == text[j : j + n] for i, j, n in zip(a[heads].tolist(), b[heads].tolist(), (size + length - 1).tolist())], bool), size)
    rest = np.flatnonzero(~same)
    if len(rest):
        same[rest] = _same(np.concatenate([raw, np.zeros(8, np.uint8)]), a[rest], b[rest], length)
    return same


def _runs(at: np.ndarray, part: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the runs of windows of one part whose distance is ``gap`` at most."""
    cut = np.flatnonzero((at[1:] - at[:-1] > gap) | (part[1:] != part[:-1]))
    return at[np.concatenate([[0], cut + 1]).astype(int)], at[np.concatenate([cut, [len(at) - 1]]).astype(int)]


def _candidates(pack: pa.Table, flags: pa.Table, length: int) -> tuple[list, list]:
    """What of a pack goes into the sort (a row of STATE), and the spans that its own equal windows remove (rows of doc, th, from, to)."""
    raw = _numbers(pack.column("text"), 0, np.uint8)
    docs, ths, begins, starts, owns = (_ints(pack.column(c), 0) for c in ("docs", "ths", "begins", "starts", "owns"))
    heads, sizes, key, grams = _keys(raw, starts, owns, length)
    shared = np.sort(np.concatenate([np.zeros(0, np.uint64), *[np.frombuffer(x.as_buffer(), np.uint64) for x in flags.column("keys")]]))
    by = np.argsort(key)
    new = np.concatenate([[True], key[by[1:]] != key[by[:-1]]])
    rank = np.empty(len(key), np.int64)  # among the distinct anchors
    rank[by] = np.cumsum(new) - 1
    hit, own = _among(key[by[new]], shared)[rank], (np.bincount(rank) > 1)[rank]
    ends = np.cumsum(owns)
    shift = starts - ends + owns  # from a window's number to its place

    def part(window: np.ndarray) -> np.ndarray:
        return np.searchsorted(ends, window, "right")

    # Equal windows of the pack: all but the first are settled.
    gone = np.zeros(ends[-1], bool)
    if len(at := np.flatnonzero(np.repeat(own, sizes))):
        place = at + shift[np.repeat(part(heads[own]), sizes[own])]
        h = grams[place]
        with np.errstate(over="ignore"):
            for k in [*range(GRAM, length - GRAM, GRAM), length - GRAM]:
                h *= _Q
                h += grams[k:][place]
        # Sorted by their first bits with each one's number in the last: places ascend among equals.
        bits = _U(len(at).bit_length())
        h >>= bits
        h <<= bits
        h |= np.arange(len(at), dtype=np.uint64)
        h.sort()
        order = (h & ((_U(1) << bits) - _U(1))).astype(np.int64)
        h >>= bits
        later = np.flatnonzero(h[1:] == h[:-1]) + 1
        first = np.ones(len(at), bool)
        first[later] = False
        twin = np.full(len(at), -1)
        twin[order[later]] = order[np.flatnonzero(first)[np.cumsum(first)[later] - 1]]
        later = np.flatnonzero(twin >= 0)
        gone[at[later[_alike(raw, place[later], place[twin[later]], length)]]] = True
    left = np.repeat(hit | own, sizes) & ~gone
    some = np.logical_or.reduceat(left, heads) & ~hit  # of these anchors, one alone has nothing left to meet
    left &= np.repeat(hit | (np.bincount(rank[some], minlength=len(key)) > 1)[rank], sizes)
    spans = []
    if len(at := np.flatnonzero(gone)):
        p = part(at)
        a, b = _runs(at + shift[p], p, length)
        p = np.searchsorted(starts, a, "right") - 1
        move = begins[p] - starts[p]
        spans = [docs[p], ths[p], a + move, b + move + length]
    at = np.flatnonzero(left)
    if not len(at):
        return [], spans
    p = part(at)
    at += shift[p]
    a, b = _runs(at, p, length)
    lens = b - a + length
    valid = np.zeros(len(raw), bool)
    valid[at] = True
    return [docs, ths, begins, starts, _pieces(raw, a, lens).tobytes(), a, lens, np.packbits(_pieces(valid, a, lens)).tobytes()], spans


# ---- suffixes of a pack


@dataclass
class Words:
    """How bytes are packed: each byte's number (from 1; 0 parts the regions), and the symbols of a word."""

    number: np.ndarray
    base: int
    symbols: int

    @staticmethod
    def of(found: list[int]) -> Words:
        number = np.zeros(256, np.uint16)
        number[sorted(found)] = np.arange(1, len(found) + 1)
        base, symbols = len(found) + 1, 1
        while base ** (symbols + 1) <= 2**64 and symbols < NAME:
            symbols += 1
        return Words(number, base, symbols)


class Suffixes:
    """The regions of a pack with a zero behind each: symbols, windows to judge, and sampled places."""

    def __init__(self, batch, row: int, words: Words, length: int):
        self.batch, self.row, self.words, self.length = batch, row, words, length
        self.text = _numbers(batch.column("text"), row, np.uint8)
        self.lens, self.froms = _ints(batch.column("lens"), row), _ints(batch.column("froms"), row)
        self.ends = np.cumsum(self.lens + 1) - 1
        self.begins = self.ends - self.lens
        self.n = int((self.lens + 1).sum())
        self.on = np.ones(self.n, bool)
        self.on[self.ends] = False

    @cached_property
    def sym(self) -> np.ndarray:
        if self.words.base > 256:
            out = np.zeros(self.n + self.length + 64, np.uint16)
            out[: self.n][self.on] = self.words.number[self.text]
        else:
            out = np.zeros(self.n + self.length + 64, np.uint8)
            out[: self.n][self.on] = np.frombuffer(self.text.tobytes().translate(self.words.number.astype(np.uint8).tobytes()), np.uint8)
        return out

    @cached_property
    def fours(self) -> np.ndarray | None:
        """The number of the four symbols at each place, if it fits in 32 bits."""
        base = self.words.base
        if base**4 >= 1 << 32:
            return None
        two = self.sym[:-1] * np.uint32(base)
        two += self.sym[1:]
        four = two[:-2] * np.uint32(base * base)
        four += two[2:]
        return four

    @cached_property
    def bytes(self) -> np.ndarray:
        out = np.zeros(self.n + self.length + 80, np.uint8)
        out[8 : self.n + 8][self.on] = self.text
        return out

    @cached_property
    def valid(self) -> np.ndarray:
        out = np.zeros(self.n + 16, np.uint8)
        out[8 : self.n + 8][self.on] = np.unpackbits(_numbers(self.batch.column("valid"), self.row, np.uint8), count=len(self.text))
        return out

    def samples(self) -> np.ndarray:
        """Of all places, whether they are sampled and a name begins there."""
        some = np.tile(_COVER, -(-self.n // PERIOD))[: self.n]
        late = (self.ends[:, None] - np.arange(NAME)).ravel()  # too near to their region's end
        some[late[late >= 0]] = False
        return some

    def sampled(self) -> np.ndarray:
        """Sampled places that a name begins at."""
        return np.flatnonzero(self.samples())

    def between(self, low: int | None, high: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Sampled places whose word is ``low`` at least and below ``high`` (None: no bound), and their words."""
        some = self.samples()
        if self.fours is not None:  # the first four symbols leave few whose words are made
            first, rest = self.fours[: self.n], self.words.base ** (self.words.symbols - 4)
            if low is not None:
                some &= first >= np.uint32(low // rest)
            if high is not None:
                some &= first <= np.uint32((high - 1) // rest)
        at = np.flatnonzero(some)
        w = self.word(at)
        mine = np.ones(len(at), bool)
        if low is not None:
            mine &= w >= _U(low)
        if high is not None:
            mine &= w < _U(high)
        return at[mine], w[mine]

    def word(self, at: np.ndarray, skip: int = 0) -> np.ndarray:
        """The word of the symbols that begin ``skip`` behind each place, NAME in all at most."""
        w, base, size = np.zeros(len(at), np.uint64), self.words.base, min(self.words.symbols, NAME - skip)
        steps = [4] * (size // 4) + [1] * (size % 4) if self.fours is not None else [1] * size
        for a in range(0, len(at), SLAB):
            some, part = w[a : a + SLAB], at[a : a + SLAB] + skip
            for n in steps:
                some *= _U(base**n)
                some += (self.sym if n == 1 else self.fours)[part]
                part += n
        return w

    def distances(self, at: np.ndarray) -> np.ndarray:
        """For each sampled place, a bit for each distance at which a window to judge begins before it."""
        with np.errstate(over="ignore"):  # the eight before as bits of the first byte, the last one lowest
            mask = (_text.numbers(self.valid)[at] * _U(0x8040201008040201) >> _U(56)).astype(np.uint16)
        mask <<= np.uint16(1)
        mask |= self.valid[at + 8]
        return mask

    def eight(self, at: np.ndarray, n: int = 8) -> np.ndarray:
        """The ``n`` bytes at each place as a number that sorts like them; what lies outside is zero."""
        return _text.numbers(self.bytes)[at + 8].byteswap() >> _U(64 - 8 * n) if n else np.zeros(len(at), np.uint64)


def _steps(length: int) -> tuple[list[int], int]:
    """Where the names of a sampled suffix begin, and how many bytes of what all its windows share lie behind the last one."""
    core = length - PERIOD + 1
    last = (core - NAME) // PERIOD * PERIOD
    return sorted({*range(0, last, NAME), last}), core - NAME - last


def _blocks(ident: int, bucket: np.ndarray, lo: int, hi: int, columns: dict[str, np.ndarray]) -> pa.RecordBatch | None:
    """Arrays in blocks by range, of the ranges from ``lo`` to before ``hi``."""
    bucket = bucket - lo
    order = np.argsort(bucket.astype(np.uint16) if hi - lo < 1 << 16 else bucket, kind="stable")  # 16 bits: by radix
    cuts = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=hi - lo))])
    some = np.flatnonzero(np.diff(cuts))
    if not len(some):
        return None
    made = []
    for c in columns.values():
        c = c[order]
        made.append(pa.array([_packed(c[cuts[b] : cuts[b + 1]]) for b in some], pa.binary()))
    return pa.RecordBatch.from_arrays([pa.array(some + lo), pa.array(np.full(len(some), ident)), *made], names=["bucket", "id", *columns])


def _joined(rows: pa.Table, names: list[str]) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """The arrays of one range, packs in ascending order: the packs, the pack of each element (its place among them), the columns."""
    rows = rows.sort_by("id")
    cols = {c: [_unpacked(x) for x in rows.column(c)] for c in names}
    sizes = [len(x) for x in cols["place"]]
    return rows.column("id").to_numpy(), np.repeat(np.arange(len(sizes)), sizes), {c: np.concatenate(v) for c, v in cols.items()}


def _back(ids: np.ndarray, pack: np.ndarray, columns: dict[str, np.ndarray], **constant) -> pa.Table:
    """Elements in ascending order of ``pack``, by pack."""
    cuts = np.searchsorted(pack, np.arange(len(ids) + 1))
    some = np.flatnonzero(np.diff(cuts))
    made = {c: pa.array([_packed(v[cuts[b] : cuts[b + 1]]) for b in some], pa.binary()) for c, v in columns.items()}
    return pa.table({"id": pa.array(ids[some]), **{k: pa.array(np.full(len(some), v)) for k, v in constant.items()}, **made})


def _by_words(keys: list[np.ndarray]) -> np.ndarray:
    """The order of elements by several words, the first one first, ties as they come: sorted by as many bits as fit beside each one's number, then those alike by the next bits."""
    order, left = np.arange(len(keys[0])), np.arange(len(keys[0]))
    group, bits = np.zeros(len(order), np.uint64), 0
    todo = [(k - k.min(), int(k.max() - k.min()).bit_length()) for k in keys] if len(order) else []
    while todo and len(left):
        at, own = order[left], len(left).bit_length()
        room = 64 - own - bits
        while room and todo:
            k, width = todo.pop(0)
            n = min(room, width)
            group = (group << _U(n)) | ((k[at] >> _U(width - n)) & _U((1 << n) - 1))
            room -= n
            if n < width:
                todo.insert(0, (k, width - n))
        group <<= _U(own)
        group |= np.arange(len(left), dtype=np.uint64)
        group.sort()
        order[left] = at[(group & _U((1 << own) - 1)).astype(np.int64)]
        group >>= _U(own)
        same = group[1:] == group[:-1]
        tied = np.zeros(len(left), bool)
        tied[1:] = same
        tied[:-1] |= same
        new = np.concatenate([[True], ~same])[tied]
        left, group = left[tied], np.cumsum(new).astype(np.uint64)
        bits = int(group[-1]).bit_length() if len(group) else 0
    return order


def _in_order(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Elements sorted by several words, the first one first, ties in the order they have; and the run of equals of each, from 0.

    Equals are brought together by a hash, and one of each is sorted.
    """
    n = len(keys[0])
    bits = _U(n.bit_length())
    with np.errstate(over="ignore"):
        h = keys[0] * _P
        for k in keys[1:]:
            h = (h ^ (h >> _U(32)) ^ k) * _Q
        h = _text.mix(h)
    h >>= bits
    h <<= bits
    h |= np.arange(n, dtype=np.uint64)
    h.sort()
    h &= (_U(1) << bits) - _U(1)
    order = h.astype(np.int64)
    new = np.zeros(n, bool)
    new[:1] = True
    for k in keys:
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
    heads = np.flatnonzero(new)
    size = np.diff(np.append(heads, n))
    one = order[heads]
    some = [k[one] for k in keys]
    by = _by_words(some)
    apart = np.zeros(max(0, len(by) - 1), bool)
    for k in some:
        k = k[by]
        apart |= k[1:] != k[:-1]
    if not apart.all():  # unequal ones of one hash lie between equals
        order, new = np.lexsort(keys[::-1]), np.zeros(n, bool)
        for k in keys:
            k = k[order]
            new[1:] |= k[1:] != k[:-1]
        return order, np.cumsum(new)
    size = size[by]
    return order[np.repeat(heads[by] - np.cumsum(size) + size, size) + np.arange(n)], np.repeat(np.arange(len(by)), size)


def _named(rows: pa.Table, n_words: int) -> pa.Table:
    """Names of the sampled places of one range, from 0: equal ones for equal NAME bytes, in the bytes' order; and how many there are."""
    ids, pack, c = _joined(rows, ["place", *[f"w{i}" for i in range(n_words)]])
    order, run = _in_order([c[f"w{i}"] for i in range(n_words)])
    name = np.empty(len(order), np.int64)
    name[order] = run
    return _back(ids, pack, {"place": c["place"], "name": name}, bucket=rows.column("bucket")[0].as_py(), names=int(run[-1]) + 1)


def _order(c: dict[str, np.ndarray], n_names: int) -> tuple[np.ndarray, np.ndarray]:
    """The sampled suffixes of a range sorted by their names and what follows, ties by pack and place; and the run of equals of each."""
    keys = [*[c[f"n{i}"] for i in range(n_names)], c["tail"]]
    keys[0] = keys[0] - keys[0].min()
    # As many in one word as fit.
    made, room = [], 0
    for k in keys:
        n = int(k.max()).bit_length()
        if not made or n > room:
            made.append(k.astype(np.uint64))
            room = 64 - n
        else:
            made[-1] = (made[-1] << _U(n)) | k
            room -= n
    return _in_order(made)


def _repeats(rows: pa.Table, n_names: int) -> pa.Table:
    """For each sampled place of one range, the distances before it at which a window begins that has an equal one at a smaller place."""
    ids, pack, c = _joined(rows, ["place", "mask", "tail", "before", "behind", *[f"n{i}" for i in range(n_names)]])
    c["mask"] = c["mask"].astype(np.uint16)
    order, run = _order(c, n_names)
    twin = run[1:] == run[:-1]
    met = np.zeros(len(order), bool)
    met[1:] |= twin
    met[:-1] |= twin
    order, run = order[met], run[met]
    n, out = len(order), np.zeros(len(order), np.uint16)
    if not n:
        return _back(ids, pack[:0], {"place": c["place"][:0], "found": out})
    mask, before, behind = (c[k][order] for k in ("mask", "before", "behind"))
    heads = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    size = np.diff(np.append(heads, n))
    even = np.ones(len(heads), bool)  # runs whose members agree in all bytes around, too
    for k in (before, behind):
        even &= np.minimum.reduceat(k, heads) == np.maximum.reduceat(k, heads)
    even = np.repeat(even, size)
    index = np.arange(n)
    for d in range(PERIOD):
        has = (mask >> np.uint16(d)) & np.uint16(1) > 0
        first = np.repeat(np.minimum.reduceat(np.where(has, index, n), heads), size)
        out |= ((has & even & (index > first)).astype(np.uint16)) << np.uint16(d)
        at = np.flatnonzero(has & ~even)
        if len(at):
            # The d bytes before, then those behind: eight in all.
            around = behind[at] if d == 0 else before[at] & _U((1 << 8 * d) - 1)
            if 0 < d < 8:
                around = (around << _U(8 * (8 - d))) | (behind[at] >> _U(8 * d))
            by = np.lexsort((around, run[at]))
            later = np.zeros(len(at), bool)
            later[1:] = (run[at][by][1:] == run[at][by][:-1]) & (around[by][1:] == around[by][:-1])
            out[at[by[later]]] |= np.uint16(1 << d)
    found = np.zeros(len(pack), np.uint16)
    found[order] = out
    on = np.flatnonzero(found)
    return _back(ids, pack[on], {"place": c["place"][on], "found": found[on]})


# ---- the whole


class Sorter:
    """The steps over the state of all packs: the cuts of the ranges, the names, the repeats."""

    def __init__(self, state: DataFrame, length: int, text_bytes: int):
        self.state, self.length = state, length
        spark = self.spark = state.sparkSession
        self.words = words = Words.of([r.b for r in state.mapInArrow(_bytes_of, "b int").distinct().collect()])
        self.names, self.tail = _steps(length)
        total = state.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        places = total * int(_COVER.sum()) // PERIOD + 1
        self.ranges = max(-(-places // RANGE_ROWS), 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.passes = max(1, -(-places * PLACE_BYTES // max(1, int(text_bytes * PASS_SHARE))))
        stride = max(1, places // CUT_ROWS)

        def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    s = Suffixes(batch, i, words, length)
                    at = s.sampled()
                    at = at[batch.column("id")[i].as_py() % stride :: stride]
                    yield pa.RecordBatch.from_arrays([pa.array(s.word(at).view(np.int64))], names=["w"])

        found = np.sort(np.array([r.w for r in state.select("id", "text", "froms", "lens", "valid").mapInArrow(sample, "w long").collect()], np.int64).view(np.uint64))
        self.cuts = np.unique(found[np.arange(1, self.ranges) * len(found) // self.ranges]) if len(found) else found
        self.ranges = len(self.cuts) + 1

    def spread(self) -> list[tuple[int, int]]:
        """The ranges of each pass."""
        ends = [self.ranges * i // self.passes for i in range(self.passes + 1)]
        return [(a, b) for a, b in zip(ends, ends[1:]) if a < b]

    def named(self) -> DataFrame:
        """The state with the names of all sampled places; ``firsts`` then has the first name of each range."""
        words, length, sent = self.words, self.length, self.spark.sparkContext.broadcast(self.cuts)
        n_words = -(-NAME // words.symbols)
        cols = ["place", *[f"w{i}" for i in range(n_words)]]
        done, folders = None, []
        for lo, hi in self.spread():

            def deal(batches: Iterator[pa.RecordBatch], lo=lo, hi=hi) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for i in range(batch.num_rows):
                        s = Suffixes(batch, i, words, length)
                        at, w = s.between(int(sent.value[lo - 1]) if lo else None, int(sent.value[hi - 1]) if hi <= len(sent.value) else None)
                        made = [w, *[s.word(at, k * words.symbols) for k in range(1, n_words)]]
                        out = _blocks(batch.column("id")[i].as_py(), np.searchsorted(sent.value[lo : hi - 1], w, "right") + lo, lo, hi, dict(zip(cols, [at, *made])))
                        if out is not None:
                            yield out

            rows = self.state.select("id", "text", "froms", "lens", "valid").mapInArrow(deal, "bucket long, id long, " + ", ".join(f"{c} binary" for c in cols))
            rows = rows.groupBy("bucket").applyInArrow(lambda t: _named(t, n_words), "id long, bucket long, names long, place binary, name binary")
            names, folder = table(rows, "names")
            folders.append(folder)
            done = names if done is None else done.unionByName(names)

        sizes = np.zeros(self.ranges, np.int64)
        for r in done.groupBy("bucket").agg(F.max("names").alias("n")).collect():
            sizes[r.bucket] = r.n
        self.firsts = np.cumsum(sizes) - sizes
        firsts = self.spark.sparkContext.broadcast(self.firsts)

        def gather(state: pa.Table, names: pa.Table) -> pa.Table:
            s = Suffixes(state, 0, words, length)
            name = np.zeros(s.n, np.uint64)
            for b, place, found in zip(*(names.column(c) for c in ("bucket", "place", "name"))):
                name[_unpacked(place).astype(np.int64)] = _unpacked(found) + _U(firsts.value[b.as_py()])
            return state.append_column("name", pa.array([_packed(name[s.sampled()])], pa.binary()))

        fields = "id long, text binary, froms array<int>, lens array<int>, valid binary"
        some = self.state.select("id", "text", "froms", "lens", "valid")
        out = table(some.groupBy("id").cogroup(done.groupBy("id")).applyInArrow(gather, fields + ", name binary"), "named")[0]
        for folder in folders:
            remove_dir(folder)
        return out

    def repeats(self, named: DataFrame) -> DataFrame:
        """id, place (binary) and found (binary): of sampled places, the distances before them at which windows are removed."""
        words, length, steps, tail = self.words, self.length, self.names, self.tail
        firsts = self.spark.sparkContext.broadcast(self.firsts)
        cols = ["place", "mask", "tail", "before", "behind", *[f"n{i}" for i in range(len(steps))]]
        done = None
        for lo, hi in self.spread():

            def deal(batches: Iterator[pa.RecordBatch], lo=lo, hi=hi) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for i in range(batch.num_rows):
                        s = Suffixes(batch, i, words, length)
                        at = s.sampled()
                        name = np.zeros(s.n + length, np.uint64)
                        name[at] = own = _unpacked(batch.column("name")[i])
                        mine = own >= _U(firsts.value[lo])
                        if hi < len(firsts.value):
                            mine &= own < _U(firsts.value[hi])
                        at = at[mine]
                        mask = s.distances(at)
                        mine = mask > 0
                        at = at[mine]
                        bucket = np.searchsorted(firsts.value[lo:hi].astype(np.uint64), name[at], "right") - 1 + lo
                        behind = at + steps[-1] + NAME
                        made = [at, mask[mine], s.eight(behind, tail), s.eight(at - 8), s.eight(behind + tail), *[name[at + k] for k in steps]]
                        out = _blocks(batch.column("id")[i].as_py(), bucket, lo, hi, dict(zip(cols, made)))
                        if out is not None:
                            yield out

            rows = named.mapInArrow(deal, "bucket long, id long, " + ", ".join(f"{c} binary" for c in cols))
            rows = rows.groupBy("bucket").applyInArrow(lambda t: _repeats(t, len(steps)), "id long, place binary, found binary")
            found = table(rows, "repeats")[0]
            done = found if done is None else done.unionByName(found)
        return done


def _bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct bytes of all texts of a partition."""
    on = np.zeros(256, bool)
    for batch in batches:
        for i in range(batch.num_rows):
            on |= np.bincount(_numbers(batch.column("text"), i, np.uint8), minlength=256) > 0
    yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(on).astype(np.int32))], names=["b"])


def _span_rows(docs, ths, begin, end) -> pa.Table:
    return pa.table({"doc": pa.array(docs, pa.int64()), "th": pa.array(ths, pa.int64()), "begin": pa.array(begin, pa.int64()), "end": pa.array(end, pa.int64())})


def _spans(state: pa.Table, found: pa.Table, words: Words, length: int) -> pa.Table:
    """The spans of a pack that the sort removes."""
    if not state.num_rows or not found.num_rows:
        return _span_rows([], [], [], [])
    s = Suffixes(state, 0, words, length)
    on = np.zeros(s.n, bool)
    place, mask = (np.concatenate([_unpacked(x) for x in found.column(c)]).astype(kind) for c, kind in (("place", np.int64), ("found", np.uint16)))
    for d in range(PERIOD):
        on[place[mask & np.uint16(1 << d) > 0] - d] = True
    at = np.flatnonzero(on)
    region = np.searchsorted(s.begins, at, "right") - 1
    a, b = _runs(at, region, length)
    r = np.searchsorted(s.begins, a, "right") - 1
    docs, ths, begins, starts = (_ints(state.column(c), 0) for c in ("docs", "ths", "begins", "starts"))
    raw = s.froms[r] + a - s.begins[r]
    p = np.searchsorted(starts, raw, "right") - 1
    begin = raw - starts[p] + begins[p]
    return _span_rows(docs[p], ths[p], begin, begin + (b - a) + length)


def _keyed(docs: DataFrame) -> DataFrame:
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))
    return docs.select(doc.alias("doc"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("th"), "doc_id", "text")


def spans(docs: DataFrame, length: int = LENGTH, pack_bytes: int = PACK_BYTES) -> DataFrame:
    """doc, th, begin and end (bytes) of all spans that go; they may touch and overlap. ``doc`` is doc_id (null: the largest long), ``th`` a hash of the text, which tells rows of one doc_id apart."""
    spark = docs.sparkSession
    ship(spark)
    if length < GRAM + PERIOD + 7:
        raise ValueError(f"windows have {GRAM + PERIOD + 7} bytes at least")
    texts = _keyed(docs).where(F.octet_length("text") >= length).select("doc", "th", "text")
    texts = texts.repartitionByRange("doc", "th").sortWithinPartitions("doc", "th")
    packs = table(texts.mapInArrow(lambda b: _parts(b, length, pack_bytes), PACK).select(F.monotonically_increasing_id().alias("id"), "*"), "packs")
    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    anchors = packs[0].select("id", "starts", "owns", "text").mapInArrow(lambda b: _anchor_rows(b, length, ranges), "bucket long, id long, keys binary")
    flags = table(anchors.groupBy("bucket").applyInArrow(_shared, "id long, keys binary"), "anchors")

    def candidates(pack: pa.Table, flag: pa.Table) -> pa.Table:
        kept, gone = _candidates(pack, flag, length)
        doc, th, begin, end = gone or ([], [], [], [])
        values = dict(zip((x.split()[0] for x in STATE.split(", ")[1:]), kept or [None] * 8))
        kinds = [pa.list_(pa.int64())] * 3 + [pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary()]
        cols = {k: pa.array([v], t) for (k, v), t in zip(values.items(), kinds)}
        own = {f"gone_{k}": pa.array([v], pa.list_(pa.int64())) for k, v in (("doc", doc), ("th", th), ("begin", begin), ("end", end))}
        return pa.table({"id": pack.column("id"), **cols, **own})

    both = packs[0].groupBy("id").cogroup(flags[0].groupBy("id"))
    fields = STATE + "".join(f", gone_{k} array<long>" for k in ("doc", "th", "begin", "end"))
    every = table(both.applyInArrow(candidates, fields), "state")[0]
    text_bytes = packs[0].agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    for _, folder in (packs, flags):
        remove_dir(folder)
    names = ["doc", "th", "begin", "end"]
    own = every.select(F.inline(F.arrays_zip(*[F.col(f"gone_{k}").alias(k) for k in names])))
    state = every.drop(*[f"gone_{k}" for k in names]).where("text IS NOT NULL")
    if state.isEmpty():
        return own
    sorter = Sorter(state, length, text_bytes)
    found, words = sorter.repeats(sorter.named()), sorter.words
    rest = state.groupBy("id").cogroup(found.groupBy("id")).applyInArrow(lambda s, f: _spans(s, f, words, length), "doc long, th long, begin long, end long")
    return own.unionByName(rest)


def _apply(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            text = batch.column("text")[i].as_buffer() if batch.column("text")[i].is_valid else b""
            n, at, kept, runs, last = len(text), 0, [], [], -1
            for s in sorted((s["begin"], s["end"]) for s in batch.column("spans")[i].as_py() or []):
                if not 0 <= s[0] < s[1] <= n:
                    raise ValueError(f"a span {s} doesn't lie in a text of {n} bytes")
                if s[0] > last:
                    runs.append([s[0], s[1]])
                runs[-1][1] = last = max(last, s[1])
            view = memoryview(text)
            for a, b in runs:
                kept.append(view[at:a])
                at = b
            kept = b"".join([*kept, view[at:]])
            out.append((n, n - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept if with_text else None))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        cols = [pa.array(c, t) for c, t in zip(zip(*out), kinds)] if out else [pa.array([], t) for t in kinds]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


@alone
def cut_repeated_bytes(docs: DataFrame, length: int = LENGTH, with_text: bool = True, pack_bytes: int = PACK_BYTES) -> DataFrame:
    """``doc_id``, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and (``with_text``) kept, the bytes that are left, of every row.

    Each byte goes that is covered by a string of ``length`` bytes which also starts earlier: in a document of a smaller doc_id, or earlier in the same one. Null and empty texts have no bytes.
    Null doc_ids come after all others. Rows of equal doc_id and text don't make each other go; such of equal doc_id and other texts do, in the order of a hash of the text.
    Very long texts are sorted in parts that overlap and cut whole. An empty table gives no rows; other columns don't matter.
    """
    by_row = spans(docs, length, pack_bytes).groupBy("doc", "th").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    rows = _keyed(docs).join(by_row, ["doc", "th"], "left").select("doc_id", "text", "spans")
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(lambda b: _apply(b, with_text), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out if with_text else out.drop("kept")
