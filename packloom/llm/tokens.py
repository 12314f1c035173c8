"""Token files: byte-level BPE ids under a static range asymmetric numeral system (rANS).

File: ``MAGIC``, then segments. A segment holds whole documents (about ``SEGMENT`` ids): a head of six little-endian 64-bit numbers (ids,
documents, symbols, blocks, bytes of the packed tables, bytes of the blocks), the packed tables (symbols and frequencies, shared by all its
blocks; doc_ids, their validity and lengths; the block index) and the blocks. A block codes up to ``BLOCK`` ids in
interleaved lanes: id t belongs to lane t mod lanes, and all lanes share one stream of 32-bit words. Every block is independent: the index
has its offset, ids, words, lanes and the crc32 of its ids, so that blocks decode in parallel; within a block, each
checkpoint has the lanes' states and the place in the stream, from which decoding can start too.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from packloom.llm import _text
from packloom.llm._store import cut, make_dir, open_read, open_write

MAGIC = b"PLRANS1\n"
BITS = 18
LOW = np.uint64(1 << 31)
LANES, FEW_LANES = 4096, 32
BLOCK = 1 << 20
CHECKPOINT = 1 << 19
SEGMENT = 1 << 21
END_ID = 0
CACHE_PIECES = 1_000_000
#: Rows and bytes of text encoded at once.
BATCH = 256, 4 << 20
#: New pieces that the tokenizer gets at once.
LINES = 512
_U = np.uint64


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Positive frequencies that sum to 2**BITS, near in proportion to the positive ``counts``."""
    if len(counts) > 1 << BITS:
        raise ValueError("more symbols than the tables can tell apart")
    f = 1 + counts.astype(np.int64) * ((1 << BITS) - len(counts)) // max(1, int(counts.sum()))
    f[np.argmax(f)] += (1 << BITS) - int(f.sum())
    return f.astype(np.uint64)


def encode_block(s: np.ndarray, f: np.ndarray, every: int = CHECKPOINT) -> tuple[int, np.ndarray, np.ndarray, list[tuple[int, int, np.ndarray]]]:
    """Lanes, states, words and checkpoints (step, place in the words, states) of the symbols ``s`` under frequencies ``f``."""
    lanes = LANES if len(s) >= 32 * LANES else LANES // 8 if len(s) >= 4 * LANES else FEW_LANES
    c = np.concatenate([[0], np.cumsum(f)[:-1]]).astype(np.uint64)
    fs, cs = f[s], c[s]
    x = np.full(lanes, LOW)
    steps, every = -(-len(s) // lanes), max(1, every // lanes)
    words, count, marks = [], 0, []
    for t in range(steps - 1, -1, -1):
        a, b = t * lanes, min((t + 1) * lanes, len(s))
        ft, y = fs[a:b], x[: b - a]
        over = y >= ft << _U(63 - BITS)
        if over.any():
            out = y[over]
            words.append(out.astype(np.uint32)[::-1])
            count += len(out)
            y = np.where(over, y >> _U(32), y)
        q = y // ft
        x[: b - a] = (q << _U(BITS)) + (y - q * ft) + cs[a:b]
        if t and t % every == 0:
            marks.append((t, count, x.copy()))
    stream = np.concatenate(words)[::-1] if words else np.zeros(0, np.uint32)
    return lanes, x, stream, [(t, count - n, y) for t, n, y in reversed(marks)]


def decode_block(n: int, lanes: int, x: np.ndarray, words: np.ndarray, f: np.ndarray, step: int = 0, at: int = 0) -> np.ndarray:
    """The symbols from ``step`` on, given the lanes' states there and the place ``at`` in the words."""
    c = np.concatenate([[0], np.cumsum(f)[:-1]]).astype(np.uint64)
    symbol = np.repeat(np.arange(len(f), dtype=np.int32), f.astype(np.int64))
    out, x = np.zeros(n, np.int32), x.copy()
    words = words.astype(np.uint64)
    mask = _U((1 << BITS) - 1)
    for t in range(step, -(-n // lanes)):
        a, b = t * lanes, min((t + 1) * lanes, n)
        y = x[: b - a]
        slot = y & mask
        s = symbol[slot.astype(np.int64)]
        out[a:b] = s
        y = f[s] * (y >> _U(BITS)) + slot - c[s]
        need = np.flatnonzero(y < LOW)
        if len(need):
            y[need] = (y[need] << _U(32)) | words[at : at + len(need)]
            at += len(need)
        x[: b - a] = y
    return out[step * lanes :]


def encode_segment(ids: np.ndarray, doc_ids: list[int | None], lengths: np.ndarray) -> bytes:
    counts = np.bincount(ids, minlength=1)
    symbols = np.flatnonzero(counts)
    place = np.zeros(len(counts), np.int32)
    place[symbols] = np.arange(len(symbols))
    s, counts = place[ids], counts[symbols]
    f = frequencies(counts) if len(symbols) else np.zeros(0, np.uint64)
    index, blocks, at = [], [], 0
    for a in range(0, len(ids), BLOCK):
        part = s[a : a + BLOCK]
        lanes, x, words, marks = encode_block(part, f)
        body = b"".join([x.tobytes(), *(np.array([t, p], np.uint64).tobytes() + y.tobytes() for t, p, y in marks), words.astype("<u4").tobytes()])
        index.append([at, len(part), len(words), lanes, len(marks), zlib.crc32(ids[a : a + BLOCK].astype("<u4").tobytes())])
        blocks.append(body)
        at += len(body)
    valid = np.array([d is not None for d in doc_ids], np.uint8)
    known = np.array([d or 0 for d in doc_ids], np.int64)
    tables = zlib.compress(b"".join([symbols.astype("<u4").tobytes(), f.astype("<u4").tobytes(), known.tobytes(), valid.tobytes(), lengths.astype("<i8").tobytes(), np.array(index, "<i8").tobytes()]), 1)
    head = np.array([len(ids), len(doc_ids), len(symbols), len(index), len(tables), at], "<i8")
    return b"".join([head.tobytes(), tables, *blocks])


def read_segments(file) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """(doc_ids, lengths, ids) of each segment; ValueError where a checksum fails."""
    if file.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a token file")
    while head := file.read(48):
        n, docs, k, blocks, packed, size = np.frombuffer(head, "<i8").tolist()
        raw, body = zlib.decompress(file.read(packed)), file.read(size)
        parts, at = [], 0
        for kind, count in (("<u4", k), ("<u4", k), ("<i8", docs), (np.uint8, docs), ("<i8", docs), ("<i8", blocks * 6)):
            parts.append(np.frombuffer(raw, kind, count, at))
            at += parts[-1].nbytes
        symbols, f, known, valid, lengths, index = parts
        f, out = f.astype(np.uint64), np.zeros(n, "<u4")
        done = 0
        for offset, m, w, lanes, marks, crc in index.reshape(-1, 6).tolist():
            x = np.frombuffer(body, np.uint64, lanes, offset)
            words = np.frombuffer(body, "<u4", w, offset + 8 * lanes + marks * (16 + 8 * lanes))
            out[done : done + m] = symbols[decode_block(m, lanes, x, words, f)]
            if zlib.crc32(out[done : done + m].tobytes()) != crc:
                raise ValueError("a block's ids don't match their checksum")
            done += m
        yield [d if v else None for d, v in zip(known.tolist(), valid.tolist())], lengths, out


class _Table:
    """Open addressing from 64-bit hashes (not 0) to entry numbers, by whole arrays."""

    def __init__(self, bits: int = 16):
        self.bits, self.used = bits, 0
        self.keys, self.entries = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Entry numbers; -1 where there is none."""
        mask = (1 << self.bits) - 1
        at = (h >> _U(64 - self.bits)).astype(np.int64)
        key = self.keys[at]
        out = np.where(key == h, self.entries[at], np.int32(-1))
        open_ = np.flatnonzero((key != h) & (key != 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & mask
            key = self.keys[at[open_]]
            hit = key == h[open_]
            out[open_[hit]] = self.entries[at[open_[hit]]]
            open_ = open_[~hit & (key != 0)]
        return out

    def add(self, h: np.ndarray, entries: np.ndarray) -> None:
        """Add distinct hashes that aren't in the table."""
        if (self.used + len(h)) * 2 > 1 << self.bits:
            old = self.keys != 0
            h, entries = np.concatenate([self.keys[old], h]), np.concatenate([self.entries[old], entries])
            bits = max(self.bits, int(len(h) * 2).bit_length()) + 1
            self.__init__(bits)
        mask = (1 << self.bits) - 1
        at = (h >> _U(64 - self.bits)).astype(np.int64)
        self.used += len(h)
        while len(h):
            free = np.flatnonzero(self.keys[at] == 0)
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.keys[at[put]], self.entries[at[put]] = h[put], entries[put]
            rest = np.ones(len(h), bool)
            rest[put] = False
            h, entries, at = h[rest], entries[rest], (at[rest] + 1) & mask


class Encoder:
    """Ids of texts by the tokenizers library, which sees each distinct piece once.

    Byte-level BPE never merges across the cuts of its pre-tokenizer. That cuts before each single space that a non-space follows, and around a
    single line feed between non-spaces, so that the ids of such pieces in a row are the text's ids. Pieces are found in whole batches by 64-bit
    hashes of their bytes, and their bytes are compared with those of the entry that was found: a text in which a piece shares its hash with
    another goes through all of the tokenizer, and so does a text with any other white space. New pieces of Latin letters, digits and signs go to the
    tokenizer's model alone, cut as its pre-tokenizer does and many in a row; between them are line feeds, which the model joins with none of these. Other pieces, and
    those with the text of a special token, go to the tokenizer one by one.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.bare = Tokenizer(self.tokenizer.model)
        beside = re.compile(f"{_CODE[0x0A]}[{_EASY}]|[{_EASY}]{_CODE[0x0A]}")
        self.lone = len(self.feed) == 1 and not any(beside.search(t) for t in self.tokenizer.get_vocab())
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.clear()

    def clear(self) -> None:
        """Entry 0 is the end id, entry 1 the line feed; no piece is equal to them."""
        self.table, self.known, self.used, self.spelled = _Table(), 0, 0, 0
        self.flat, self.begin, self.size = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)
        self.bytes, self.where, self.meta = np.zeros(1 << 18, np.uint8), np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self._keep(np.array([END_ID, *self.feed], np.uint32), np.array([1, len(self.feed)]))

    def _keep(self, flat: np.ndarray, size: np.ndarray) -> np.ndarray:
        """New entries with these ids."""
        self.flat = _room(self.flat, self.used + len(flat))
        self.begin, self.size, self.where, self.meta = (_room(x, self.known + len(size)) for x in (self.begin, self.size, self.where, self.meta))
        new = np.arange(self.known, self.known + len(size))
        self.flat[self.used : self.used + len(flat)] = flat
        self.begin[new], self.size[new], self.meta[new] = self.used + np.cumsum(size) - size, size, -1
        self.used, self.known = self.used + len(flat), self.known + len(size)
        return new.astype(np.int32)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, lines: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces in ``lines`` (each with a line feed behind it, which is before ``ends``) in a row, and how many each has."""
        begins = np.concatenate([[0], ends[:-1]])
        kind = _SIGN[lines]
        pair = np.flatnonzero(kind[:-1] == 4)
        kind[pair + 1] = np.where((lines[pair] != 0xC3) | ((lines[pair + 1] != 0x97) & (lines[pair + 1] != 0xB7)), 1, 0)
        kind[kind == 4] = 1
        kind[ends - 1] = 5
        hard = np.logical_or.reduceat(kind == 0, begins)
        raw = lines.tobytes()
        if not self.lone or any(x in raw for x in self.special):
            hard[:] = True
        ids, at = [], np.flatnonzero(hard)
        for i in range(0, len(at), LINES):
            ids += self._whole([raw[a:b].decode("utf-8", "surrogatepass") for a, b in zip(begins[at[i : i + LINES]].tolist(), (ends[at[i : i + LINES]] - 1).tolist())])
        size = np.zeros(len(ends), np.int64)
        size[at] = [len(x) for x in ids]
        easy = np.flatnonzero(~hard)
        if not len(easy):
            return np.concatenate(ids), size
        # The model alone gets the others, cut between letters, digits and signs; a feed ends each part.
        stay = np.repeat(~hard, ends - begins)
        lines, kind = lines[stay], kind[stay]
        parts = (kind[1:] != kind[:-1]) & (kind[1:] < 5) & (kind[:-1] < 5)
        last = np.flatnonzero(kind == 5)
        cut = np.flatnonzero(parts) + 1
        spelled = np.insert(lines, cut, 0x0A)
        last += np.searchsorted(cut, last, "right")
        text = _SPELLED[spelled].tobytes().decode("utf-32-le")
        stops = [0, *(last[LINES - 1 :: LINES] + 1).tolist()]
        if stops[-1] < len(text):
            stops.append(len(text))
        got = np.concatenate([np.array(e.ids, np.uint32) for e in self.bare.encode_batch_fast([text[a:b] for a, b in zip(stops[:-1], stops[1:])], add_special_tokens=False)])
        feed = got == self.feed[0]
        place = np.flatnonzero(feed)[np.searchsorted(np.flatnonzero(spelled == 0x0A), last)]
        size[easy] = np.diff(np.cumsum(~feed)[place], prepend=0)
        out = np.zeros(int(size.sum()), np.uint32)
        of_hard = np.repeat(hard, size)
        out[~of_hard] = got[~feed]
        if ids:
            out[of_hard] = np.concatenate(ids)
        return out, size

    def _add(self, h: np.ndarray, d: np.ndarray, s: np.ndarray, e: np.ndarray, lead: np.ndarray) -> None:
        """Learn the pieces [s, e) of ``d`` with distinct hashes ``h``."""
        space = (lead == 1).astype(np.int64)
        size = e - s + space + 1
        ends = np.cumsum(size)
        lines = np.full(int(ends[-1]), 0x20, np.uint8)
        lines[ends - 1] = 0x0A
        begins = ends - 1 - (e - s)
        put = np.repeat(begins, e - s) + (inner := np.arange(int((e - s).sum())) - np.repeat(np.cumsum(e - s) - (e - s), e - s))
        lines[put] = d[np.repeat(s, e - s) + inner]
        new = self._keep(*self._learn(lines, ends))
        self.bytes = _room(self.bytes, self.spelled + len(lines) + 16)
        self.bytes[self.spelled : self.spelled + len(lines)] = lines
        self.where[new], self.meta[new] = self.spelled + begins, 2 * (e - s) + space
        self.spelled += len(lines)
        self.table.add(h, new)

    def encode(self, column: pa.Array, plain: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, each text's followed by ``END_ID``, and how many each text has. Null texts are empty. Rows marked in ``plain`` go to the tokenizer whole."""
        if self.known > CACHE_PIECES:
            self.clear()
        data, offsets = _text.column(column)
        base, n_rows = int(offsets[0]), len(offsets) - 1
        d, view = _text.padded(data[base : int(offsets[-1])])
        d, bounds = d[: len(d) - 16], offsets - base
        length = np.diff(bounds)
        kind = _KIND[d]
        gap = kind == 1
        bad = kind == 2
        i = np.flatnonzero(kind == 3)
        more = np.concatenate([d, np.zeros(2, np.uint8)])
        a, b, c = more[i], more[i + 1], more[i + 2]
        wide = (a == 0xE2) & (((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F)))
        bad[i] |= ((a == 0xC2) & ((b == 0x85) | (b == 0xA0))) | wide | ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
        start = np.zeros(len(d) + 1, bool)
        start[bounds] = True
        before_gap = np.ones(len(d), bool)
        before_gap[1:] = gap[:-1] | start[1:-1]
        bad |= gap & (before_gap | start[1:])
        at_bad = np.searchsorted(np.flatnonzero(bad), bounds)
        odd = np.diff(at_bad) > 0
        if plain is not None:
            odd |= plain
        on = ~gap
        for r in np.flatnonzero(odd).tolist():
            on[bounds[r] : bounds[r + 1]] = False
        first = on.copy()
        first[1:] &= ~on[:-1] | start[1:-1]
        last = on.copy()
        last[:-1] &= ~on[1:] | start[1:-1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        lead = np.where(start[s], 0, np.where(d[s - 1] == 0x20, 1, 2)) if len(s) else np.zeros(0, np.int64)
        spaced = lead == 1
        h = _text.span_hashes(view, s, e)
        h[spaced] = _text.mix(h[spaced])
        h |= _U(1)
        entry = self.table.find(h)
        missing = np.flatnonzero(entry < 0)
        if len(missing):
            new, at = np.unique(h[missing], return_index=True)
            at = missing[at]
            self._add(new, d, s[at], e[at], lead[at])
            entry[missing] = self.table.find(h[missing])
        counts = np.diff(np.searchsorted(s, bounds))
        row = np.repeat(np.arange(n_rows), counts)
        same = self.meta[entry] == 2 * (e - s) + spaced
        at = np.flatnonzero(same)
        begin = self.where[entry[at]]
        same[at] = _text.same_spans(view, s[at], e[at], _text.numbers(self.bytes), begin, begin + (e - s)[at])
        if not same.all():  # two pieces of one hash
            odd[row[~same]] = True
            return self.encode(column, odd)
        known, used = self.known, self.used
        whole = np.flatnonzero(odd)
        extra = np.zeros(0, np.int32)
        if len(whole):
            ids = self._whole([d[bounds[i] : bounds[i + 1]].tobytes().decode("utf-8", "surrogatepass") for i in whole.tolist()])
            extra = self._keep(np.concatenate(ids), np.array([len(x) for x in ids]))
        feeds = lead == 2
        before = np.concatenate([[0], np.cumsum(odd)])  # entries of odd texts, one each
        place = np.arange(len(s)) + np.cumsum(feeds) + row + before[row]
        per_row = counts + np.bincount(row[feeds], minlength=n_rows) + 1 + odd
        ends = np.cumsum(per_row)
        entries = np.zeros(int(ends[-1]) if n_rows else 0, np.int32)
        entries[place] = entry
        entries[place[feeds] - 1] = 1
        entries[ends[whole] - 2] = extra
        n = self.size[entries].astype(np.int64)
        total = np.cumsum(n)
        ids = self.flat[np.repeat(self.begin[entries] - (total - n), n) + np.arange(int(total[-1]) if n_rows else 0)]
        self.known, self.used = known, used  # odd texts aren't remembered
        return ids, np.diff(np.concatenate([[0], total[ends - 1]])) if n_rows else np.zeros(0, np.int64)


def _room(x: np.ndarray, n: int) -> np.ndarray:
    """``x``, or a copy twice as long or longer that holds ``n``."""
    if n <= len(x):
        return x
    out = np.zeros(max(n, 2 * len(x)), x.dtype)
    out[: len(x)] = x
    return out


def _codes() -> str:
    """The sign that byte-level BPE writes for each byte: printable ones stand for themselves, others follow from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return "".join(chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256))


_CODE = _codes()
_SPELLED = np.frombuffer(_CODE.encode("utf-32-le"), "<u4")
#: 1: ASCII letters; 2: digits; 3: signs but the apostrophe (it may begin an English ending); 4: lead bytes of Latin letters up to U+017F; 0: others. A space is of the kind of none.
_SIGN = np.zeros(256, np.uint8)
_SIGN[[*range(0x21, 0x27), *range(0x28, 0x7F)]] = 3
_SIGN[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_SIGN[[*range(0x30, 0x3A)]] = 2
_SIGN[[0xC3, 0xC4, 0xC5]] = 4
_SIGN[0x20] = 6
_EASY = re.escape("".join(_CODE[b] for b in range(256) if _SIGN[b]))
#: 1: space and line feed; 2: other white space; 3: lead bytes of signs beyond ASCII of which some are white space.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x0A]] = 1
_KIND[[0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F]] = 2
_KIND[[0xC2, 0xE1, 0xE2, 0xE3]] = 3

_encoders: dict[str, Encoder] = {}


def write_tokens(docs: DataFrame, folder: str, path: str) -> DataFrame:
    """Write the ids of all ``docs`` in ascending doc_id order (nulls first, equal ones by the xxhash64 of their texts) to files below ``folder``; return the manifest.

    A task writes files named by itself; only the manifest rows (file, part, seq, n_tokens) of finished tasks name files, and
    files in the order of (part, seq) hold all documents in order. ``path`` is the tokenizer's file.
    """
    make_dir(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = _encoders.get(path) or _encoders.setdefault(path, Encoder(path))
        out, name, total = None, "", 0
        ids, lengths, known = [], [], []

        def flush() -> None:
            nonlocal out, name, total
            if out is None:
                name = f"{folder}/{uuid.uuid4().hex}.rans"
                out = open_write(name)
                out.write(MAGIC)
            every = np.concatenate(ids)
            out.write(encode_segment(every, list(known), np.concatenate(lengths)))
            total += len(every)
            for x in (ids, lengths, known):
                x.clear()

        for whole in batches:
            for batch in _text.slices(whole, "text", *BATCH):
                i, n = encoder.encode(batch.column("text"))
                ids.append(i)
                lengths.append(n)
                known.extend(batch.column("doc_id").to_pylist())
                if sum(map(len, ids)) >= SEGMENT:
                    flush()
        if known:
            flush()
        if out is not None:
            out.close()
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([part], pa.int64()), pa.array([total], pa.int64())], names=["file", "part", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    ordered = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")  # rows of one doc_id can be split
    return cut(ordered.mapInArrow(write, "file string, part long, n_tokens long"))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of all documents in the files of a manifest, from their decoded ids."""
    files = manifest.withColumn("start", F.sum("n_tokens").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)))
    files = cut(files.select("file", F.coalesce("start", F.lit(0)).alias("start")))  # one row a file

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                with open_read(name) as file:
                    for doc_ids, lengths, ids in read_segments(file):
                        ends = np.cumsum(lengths)
                        crc = [zlib.crc32(ids[a:b]) for a, b in zip((ends - lengths).tolist(), ends.tolist())]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(doc_ids, pa.int64()), pa.array(start + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"],
                        )
                        start += len(ids)

    n = max(1, files.count())
    return files.repartition(min(n, 10_000)).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_rows(docs: DataFrame, folder: str, path: str) -> DataFrame:
    """Write ``docs`` as token files below ``folder`` and read them back: doc_id, start, n_tokens (with the end id) and ids_crc32 of every row.

    Null and empty texts have the end id alone; null doc_ids come first, and rows of one doc_id follow each other by the hash of their texts; a very long text is
    encoded in one piece (some 100 bytes of memory a byte of it); an empty table writes nothing and gives no rows; other columns don't matter.
    """
    return read_tokens(write_tokens(docs, folder, path))
