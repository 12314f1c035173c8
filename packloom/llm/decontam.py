"""Benchmark decontamination: a bottom-k MinHash containment search with exact verification.

A test item of n shingles leaks into a document that has at least ``need`` = ceil(share * n) of them. An item's
sketch is its n - need + 1 smallest shingle hashes (a bottom-k MinHash): a document that has ``need`` of
the n shingles can miss at most n - need, so it shares one with the sketch. The search therefore finds every leak,
however long the document is; MinHash banding of whole documents can't (30 shingles in 20,000 have a Jaccard
similarity of 0.0015). Items are partitioned by size, one partition for each power of two of shingles: a partition has the list of its sketches, and a document
is looked up in those partitions only of which it is large enough to hold an item. Candidates are verified on the full shingle sets: where a document has the hash of one of the item's
shingles, the words themselves are compared.

The items are the stated query set: the driver builds the index of at most ``block_bytes`` of text at a time, which is carried to the documents,
one pass over the documents each. Documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packloom.llm import _text
from packloom.llm._store import fresh
from packloom.ship import ship

WORDS = 5
#: Rows and bytes of text searched at once.
BATCH = 1000, 4 << 20
PERCENT = 75
_MASK = np.uint64((1 << 20) - 1)


class Windows:
    """All k-word shingles of a column's rows in order (a row of fewer words has one, the whole): their hashes, rows and bytes."""

    def __init__(self, arr: pa.Array, k: int):
        words = _text.Words(arr, lower=True)
        w, bounds, counts = words.w, words.bounds, np.diff(words.bounds)
        row = np.repeat(np.arange(len(counts)), counts)
        every = _text.sequences(w, k)
        first = np.flatnonzero(row[: len(every)] == row[k - 1 :]) if len(every) else np.zeros(0, np.int64)
        hashes, size = [every[first]], [np.full(len(first), k)]
        short = np.flatnonzero((counts > 0) & (counts < k))
        for a, n in zip(bounds[short].tolist(), counts[short].tolist()):
            with np.errstate(over="ignore"):
                hashes.append(_text.sequences(w[a : a + n], n) + np.uint64(n))
        first, size = np.concatenate([first, bounds[short]]), np.concatenate([*size, counts[short]])
        self.hashes, self.rows = np.concatenate(hashes), row[first] if len(row) else first
        self.first, self.size = first, size
        if len(short):
            order = np.argsort(self.rows, kind="stable")
            self.hashes, self.rows, self.first, self.size = self.hashes[order], self.rows[order], first[order], size[order]
        self.begin = np.searchsorted(self.rows, np.arange(len(counts) + 1))
        self.sizes = np.diff(self.begin)
        self._words = words

    def spell(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The rows' words in a buffer, and where each shingle begins and ends there."""
        raw, stop = self._words.spelled()
        return _text.padded(raw)[0], stop[self.first], stop[self.first + self.size]


class Index:
    """Items' distinct shingles, each with its hash and its words, and the sketches by which they are found; all in arrays."""

    def __init__(self, ids: list[int | None], texts: list[str | None], k: int, percent: int):
        found = Windows(pa.array(texts, pa.string()), k)
        self.ids = ids
        self.buf, start, end = found.spell()
        order = np.lexsort((found.hashes, found.rows))
        view, h, item, start, end = _text.numbers(self.buf), found.hashes[order], found.rows[order], start[order], end[order]
        twin = np.flatnonzero((h[1:] == h[:-1]) & (item[1:] == item[:-1])) + 1
        keep = np.ones(len(h), bool)
        keep[twin[_text.same_spans(view, start[twin], end[twin], view, start[twin - 1], end[twin - 1])]] = False
        if keep[twin].any():  # two shingles of one item and one hash: tell them all by their bytes
            seen: set[tuple[int, bytes]] = set()
            for i, (r, a, b) in enumerate(zip(item.tolist(), start.tolist(), end.tolist())):
                key = (r, self.buf[a:b].tobytes())
                keep[i] = key not in seen
                seen.add(key)
        self.h, self.start, self.end, item = h[keep], start[keep], end[keep], item[keep]
        self.begin = np.searchsorted(item, np.arange(len(ids) + 1))
        self.n = np.diff(self.begin)
        self.need = -(-percent * self.n // 100)
        order = np.lexsort((_text.mix(self.h), item))
        rank = np.arange(len(order)) - self.begin[item]
        sketch = order[rank <= (self.n - self.need)[item]]
        hashes, item = self.h[sketch], item[sketch]
        self.seen = np.zeros(int(_MASK) + 1, bool)
        self.seen[(hashes & _MASK).astype(np.int64)] = True
        part = np.floor(np.log2(np.maximum(self.n, 1))).astype(np.int64)[item]
        self.parts = []  # (least need, sketch hashes in order, their items)
        for p in np.unique(part).tolist():
            mine = np.flatnonzero(part == p)
            mine = mine[np.argsort(hashes[mine], kind="stable")]
            self.parts.append((int(self.need[item[mine]].min()), hashes[mine], item[mine]))

    def candidates(self, docs: Windows) -> np.ndarray:
        """Distinct (row, item) whose row has a sketch hash of the item and the size to hold it."""
        near, found = np.flatnonzero(self.seen[(docs.hashes & _MASK).astype(np.int64)]), [np.zeros((0, 2), np.int64)]
        for least, own, items in self.parts:
            fit = near[docs.sizes[docs.rows[near]] >= least]
            lo = np.searchsorted(own, docs.hashes[fit], "left")
            n = np.searchsorted(own, docs.hashes[fit], "right") - lo
            inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            row, item = np.repeat(docs.rows[fit], n), items[np.repeat(lo, n) + inner]
            fits = docs.sizes[row] >= self.need[item]
            found.append(np.stack([row[fits], item[fits]], 1))
        return np.unique(np.concatenate(found), axis=0)

    def leaks(self, docs: Windows) -> list[tuple[int, int, int]]:
        """(row, item, shared) of the rows that have enough of an item's shingles, word for word."""
        pairs, out = self.candidates(docs), []
        if not len(pairs):
            return out
        buf, start, end = docs.spell()
        view, own = _text.numbers(buf), _text.numbers(self.buf)
        last = -1
        for r, i in pairs.tolist():
            if r != last:
                last, a, b = r, int(docs.begin[r]), int(docs.begin[r + 1])
                places = a + np.argsort(docs.hashes[a:b], kind="stable")
                h = docs.hashes[places]
            mine = np.arange(self.begin[i], self.begin[i + 1])
            lo = np.searchsorted(h, self.h[mine], "left")
            n = np.searchsorted(h, self.h[mine], "right") - lo
            j = np.repeat(mine, n)
            p = places[np.repeat(lo, n) + np.arange(len(j)) - np.repeat(np.cumsum(n) - n, n)]
            same = _text.same_spans(view, start[p], end[p], own, self.start[j], self.end[j])
            shared = len(np.unique(j[same]))
            if shared >= self.need[i]:
                out.append((r, i, shared))
        return out


def leak_pairs(docs: DataFrame, items: DataFrame, k: int = WORDS, percent: int = PERCENT, block_bytes: int = 16 << 20) -> DataFrame:
    """(doc_id, item_id, n_item_shingles, n_shared, containment) of all documents that hold ``percent`` of an item's shingles or more.

    Words are runs outside ASCII white space, A-Z lower-cased; a text of fewer than ``k`` words has one shingle, the whole.
    Null and empty texts have none: such items leak nowhere, such documents hold nothing. Null ids are carried as null;
    repeated rows give repeated pairs; very long texts are searched whole, some 40 bytes of memory a word; empty tables give no pairs; other columns don't matter.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_item_shingles", pa.int64()), ("n_shared", pa.int64()), ("containment", pa.float64())])
    ship(docs.sparkSession)
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-total // block_bytes))
    out = None
    for i in range(n_blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == i).collect()
        index = docs.sparkSession.sparkContext.broadcast(Index([r.item_id for r in block], [r.text for r in block], k, percent))

        def search(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            found = index.value
            for whole in batches:
                for batch in _text.slices(whole, "text", *BATCH):
                    got = found.leaks(Windows(batch.column("text"), k))
                    if got:
                        doc_ids = batch.column("doc_id")
                        rows = [(doc_ids[r].as_py(), found.ids[i], n := int(found.n[i]), shared, shared / n) for r, i, shared in got]
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        some = docs.mapInArrow(search, "doc_id long, item_id long, n_item_shingles long, n_shared long, containment double")
        out = some if out is None else out.unionByName(some)
    return out


def without_leaks(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """``docs`` without the documents that hold an item. Rows with a null doc_id are judged together: all go if one of them leaks."""
    name = fresh(docs, "leaking")
    leaks = leak_pairs(docs, items, **how).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(leaks, F.col("doc_id").cast("long").eqNullSafe(F.col(name)), "left_anti")
