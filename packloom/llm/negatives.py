"""Hard-negative mining by product quantisation with stored residual norms.

A row is stored as a code in each of ``PARTS`` slices of its components, with the norm of what the slice's codeword leaves (rounded up). An
anchor has a table of its inner products with all codewords: a row's sum over the slices, plus or minus the sum of residual norms times the norms of the
anchor's slices, bounds its score from both sides (Cauchy and Schwarz). Rows that can't be among the best, or can't lie in a window, are left out
rigorously; the others are ranked by exact scores. Codewords are whole numbers, so that sums of table entries are exact.

Anchors are worked on in blocks of ``BLOCK_BYTES``, each sent to all tasks and held against all rows: first for the positives, then for the negatives in the windows that
the positives' scores give. A task keeps the best of its rows only, and their scores raise the bounds for its next rows; Spark merges the tasks' bests.

Codewords are fitted on at most ``FIT_ROWS`` rows, those of the smallest hashes; which rows they are changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from packloom.llm._store import alone, cut
from packloom.llm._vectors import lists, matrix, sound, whole
from packloom.ship import ship

PARTS, WORDS, STEPS = 16, 256, 6
FIT_ROWS = 4096
#: Bytes of anchors worked on in one pass over all rows.
BLOCK_BYTES = 16 << 20
#: Rows and anchors compared at once.
ROWS, ANCHORS = 4096, 128
POSITIVES, NEGATIVES, LOW, HIGH, SCALE = 5, 3, 50, 95, 256
_UP = 1 + 2.0**-40
_LAST = 2**63 - 1


class Codebook:
    """Whole-number codewords for each slice of ``dims`` components, fitted by k-means on some rows."""

    def __init__(self, rows: np.ndarray, dims: int):
        self.cuts = np.unique(np.linspace(0, dims, min(PARTS, dims) + 1).astype(int))
        self.words = [self._fit(rows[:, a:b].astype(np.float64)) for a, b in self.slices()]

    def slices(self) -> list[tuple[int, int]]:
        return list(zip(self.cuts[:-1].tolist(), self.cuts[1:].tolist()))

    @staticmethod
    def _nearest(x: np.ndarray, words: np.ndarray) -> np.ndarray:
        out = np.empty(len(x), np.int64)
        for a in range(0, len(x), ROWS):
            out[a : a + ROWS] = ((words * words).sum(1) - 2 * (x[a : a + ROWS] @ words.T)).argmin(1)
        return out

    @classmethod
    def _fit(cls, x: np.ndarray) -> np.ndarray:
        words = np.unique(x, axis=0)
        if len(words) > WORDS:
            words = words[np.linspace(0, len(words) - 1, WORDS).astype(int)]
            for _ in range(STEPS):
                own = cls._nearest(x, words)
                n = np.bincount(own, minlength=len(words))
                total = np.zeros_like(words)
                np.add.at(total, own, x)
                words = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], words)
        return np.rint(words) if len(words) else np.zeros((1, x.shape[1]))

    def encode(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The codes of rows, and the norms of their residuals, by slice."""
        codes, norms = np.empty((len(v), len(self.words)), np.uint8), np.empty((len(v), len(self.words)), np.float32)
        for s, ((a, b), words) in enumerate(zip(self.slices(), self.words)):
            x = v[:, a:b].astype(np.float64)
            codes[:, s] = own = self._nearest(x, words)
            left = x - words[own]
            norms[:, s] = np.nextafter((np.sqrt((left * left).sum(1)) * _UP).astype(np.float32), np.float32(np.inf))
        return codes, norms

    def tables(self, anchors: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """For each slice the codewords' inner products with the anchors, and the norms of the anchors' slices."""
        tables, norms = [], np.empty((len(self.words), len(anchors)))
        for s, ((a, b), words) in enumerate(zip(self.slices(), self.words)):
            x = anchors[:, a:b].astype(np.float64)
            tables.append(words @ x.T)
            norms[s] = np.sqrt((x * x).sum(1)) * _UP
        return tables, norms


def bounds(codes: np.ndarray, norms: np.ndarray, tables: list[np.ndarray], anchor_norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Below and above each row's (row) score with each anchor (column)."""
    mid = tables[0][codes[:, 0]]
    for s in range(1, len(tables)):
        mid += tables[s][codes[:, s]]
    wide = norms.astype(np.float64) @ anchor_norms * _UP
    return mid - wide, mid + wide


def scores(v: np.ndarray, anchors: np.ndarray, row: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Exact inner products of pairs of rows and anchors; whole numbers below 2**53 add up exactly in floating point."""
    if 8 * len(row) > len(v) * len(anchors):
        return (v.astype(np.float64) @ anchors.T.astype(np.float64))[row, anchor].astype(np.int64)
    out = np.empty(len(row), np.int64)
    for a in range(0, len(row), 1 << 16):
        out[a : a + (1 << 16)] = np.einsum("ij,ij->i", v[row[a : a + (1 << 16)]].astype(np.int64), anchors[anchor[a : a + (1 << 16)]].astype(np.int64))
    return out


class Best:
    """For each of ``n`` lists the ``k`` best (score, id) so far: higher scores first, ties by smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score, self.id, self.held = np.full((n, k), -_LAST), np.full((n, k), _LAST), np.zeros((n, k), bool)

    def floor(self) -> tuple[np.ndarray, np.ndarray]:
        """What must be beaten to enter a list; where it has room, anything does."""
        return np.where(self.held[:, -1], self.score[:, -1], -_LAST), np.where(self.held[:, -1], self.id[:, -1], _LAST)

    def add(self, at: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        least, last = self.floor()
        enters = ~self.held[at, -1] | (score > least[at]) | ((score == least[at]) & (ident < last[at]))
        at, score, ident = at[enters], score[enters], ident[enters]
        if not len(at):
            return
        lists_ = np.unique(at)
        old = self.held[lists_]
        at = np.concatenate([at, np.repeat(lists_, old.sum(1))])
        score, ident = np.concatenate([score, self.score[lists_][old]]), np.concatenate([ident, self.id[lists_][old]])
        order = np.lexsort((ident, -score, at))
        at, score, ident = at[order], score[order], ident[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        on = place < self.k
        self.held[lists_] = False
        self.score[at[on], place[on]], self.id[at[on], place[on]], self.held[at[on], place[on]] = score[on], ident[on], True


def coded(rows: DataFrame, anchors: Column, scale: int, fit_rows: int = FIT_ROWS) -> tuple[DataFrame, Codebook, int]:
    """A written table of the rows that take part: uid, id, label, anchor, v, code, norm; the codebook; the number of components."""
    spark = rows.sparkSession
    ship(spark)
    rows = rows.where(F.col("label").isNotNull() & sound("embedding"))
    dims = max(1, rows.agg(F.max(F.size("embedding"))).first()[0] or 0)
    most = int((2**52 // dims) ** 0.5)
    anchor = F.coalesce(anchors, F.lit(False))
    rows = rows.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), anchor.alias("anchor"), whole("embedding", scale, most).alias("v"))
    fit = rows.select("v").orderBy(F.xxhash64("id", "v"), "v").limit(fit_rows)
    sample = [r.v for r in fit.collect()]
    full = np.zeros((len(sample), dims), np.int64)
    for i, v in enumerate(sample):
        full[i, : len(v)] = v
    book = Codebook(full, dims)
    sent = spark.sparkContext.broadcast(book)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, norms = sent.value.encode(matrix(batch.column("v"), dims, np.int32))
            width = codes.shape[1]
            code = pa.Array.from_buffers(pa.binary(), len(codes), [None, pa.py_buffer((np.arange(len(codes) + 1) * width).astype(np.int32).tobytes()), pa.py_buffer(codes.tobytes())])
            yield pa.RecordBatch.from_arrays([*batch.columns, code, lists(norms)], names=[*batch.schema.names, "code", "norm"])

    done = rows.mapInArrow(encode, "id long, label long, anchor boolean, v array<int>, code binary, norm array<float>")
    return cut(done.select(F.monotonically_increasing_id().alias("uid"), "*")), book, dims


def _rows(batch: pa.RecordBatch, dims: int, parts: int) -> tuple[np.ndarray, ...]:
    ids = np.asarray(batch.column("id").fill_null(_LAST))
    code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, parts)
    return ids, np.asarray(batch.column("label")), matrix(batch.column("v"), dims, np.int32), code, matrix(batch.column("norm"), parts, np.float32)


class Anchors:
    """A block of anchors: uid, id, label, vectors, and for the second pass their windows (rows of: anchor's place, rank and id of the positive, its score)."""

    def __init__(self, rows: list, dims: int, windows: list | None = None):
        self.uid, self.id, self.label = (np.array([r[c] for r in rows], np.int64) for c in ("uid", "id", "label"))
        self.v = np.zeros((len(rows), dims), np.int32)
        for i, r in enumerate(rows):
            self.v[i, : len(r.v)] = r.v
        place = {u: i for i, u in enumerate(self.uid.tolist())}
        windows = sorted((place[r.uid], r.k, _LAST if r.positive_id is None else r.positive_id, r.score) for r in windows or [])
        self.of, self.k, self.positive, self.score = (np.array(c, np.int64) for c in (zip(*windows) if windows else ((), (), (), ())))


def _positives(batches: Iterator[pa.RecordBatch], block: Anchors, book: Codebook, dims: int, k: int) -> Iterator[pa.RecordBatch]:
    best, parts = Best(len(block.uid), k), len(book.words)
    by_label = {x: np.flatnonzero(block.label == x) for x in np.unique(block.label).tolist()}
    tables: dict = {}
    for whole_batch in batches:
        for at in range(0, whole_batch.num_rows, ROWS):
            ids, label, v, code, norm = _rows(whole_batch.slice(at, ROWS), dims, parts)
            for x in np.unique(label).tolist():
                mine, rows = by_label.get(x, ()), np.flatnonzero(label == x)
                for a in range(0, len(mine), ANCHORS):
                    some = mine[a : a + ANCHORS]
                    if (x, a) not in tables:
                        tables.clear()
                        tables[x, a] = book.tables(block.v[some])
                    least, _ = best.floor()
                    _, high = bounds(code[rows], norm[rows], *tables[x, a])
                    r, c = np.nonzero((high >= least[some]) & (ids[rows][:, None] != block.id[some]))
                    best.add(some[c], scores(v[rows], block.v[some], r, c), ids[rows][r])
    at, place = np.nonzero(best.held)
    yield pa.RecordBatch.from_arrays([pa.array(block.uid[at]), pa.array(best.id[at, place]), pa.array(best.score[at, place])], names=["uid", "positive_id", "score"])


def _negatives(batches: Iterator[pa.RecordBatch], block: Anchors, book: Codebook, dims: int, k: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    best, parts = Best(len(block.of), k), len(book.words)
    to = high * block.score // 100  # the largest whole score of a window, and the smallest
    frm = -(-low * block.score // 100)
    live = np.flatnonzero(frm <= to)
    order, first = live[np.argsort(block.of[live], kind="stable")], np.unique(block.of[live])
    begin = np.searchsorted(block.of[order], first)
    count = np.diff(np.append(begin, len(order)))
    for whole_batch in batches:
        for at in range(0, whole_batch.num_rows if len(first) else 0, ROWS):
            ids, label, v, code, norm = _rows(whole_batch.slice(at, ROWS), dims, parts)
            for a in range(0, len(first), ANCHORS):
                some = first[a : a + ANCHORS]
                least = np.maximum(best.floor()[0], frm)[order]
                least, most = (f.reduceat(x, begin)[a : a + ANCHORS] for f, x in ((np.minimum, least), (np.maximum, to[order])))
                below, above = bounds(code, norm, *book.tables(block.v[some]))
                r, c = np.nonzero((above >= least) & (below <= most) & (label[:, None] != block.label[some]))
                got = scores(v, block.v[some], r, c)
                n = count[a : a + ANCHORS][c]  # each pair once for each window of the anchor
                pair = np.repeat(np.arange(len(c)), n)
                window = order[np.repeat(begin[a : a + ANCHORS][c], n) + np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)]
                inside = (got[pair] >= frm[window]) & (got[pair] <= to[window])
                best.add(window[inside], got[pair[inside]], ids[r[pair[inside]]])
    at, place = np.nonzero(best.held)
    cols = [block.uid[block.of[at]], block.k[at], block.positive[at], block.score[at], best.id[at, place], best.score[at, place]]
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["uid", "k", "positive_id", "positive_score", "negative_id", "negative_score"])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


@alone
def hard_negatives(rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score: for each anchor (rows of ``vec_id, label, embedding`` that fulfil ``anchors``) and each of its
    ``positives`` best rows of the same label, the ``negatives`` best of the rows of other labels that score from ``low`` to ``high`` percent of the positive.

    Scores are inner products of floor(scale * x); higher ones come first, ties by smaller vec_id (null last). Rows with a null label, a null vector or null or non-finite
    components take no part; shorter vectors are filled with zeros. Rows of the anchor's own vec_id aren't its positives; an anchor without vec_id is none. Repeated
    rows rank as often as they occur, repeated anchors have rows each. Negative positive scores have empty windows, 0 has the scores of 0. A component whose scores wouldn't add up exactly fails.
    An empty table gives no rows; other columns don't matter.
    """
    spark = rows.sparkSession
    every, book, dims = coded(rows, anchors & F.col("vec_id").isNotNull(), scale)
    chosen = every.where("anchor")
    blocks = max(1, -(-chosen.count() * dims * 4 // block_bytes))
    found, pairs = [], every.select("id", "label", "v", "code", "norm")
    for i in range(blocks):
        mine = chosen.where(F.pmod(F.xxhash64("uid"), F.lit(blocks)) == i).select("uid", "id", "label", "v").collect()
        sent = spark.sparkContext.broadcast((Anchors(mine, dims), book))
        near = pairs.mapInArrow(lambda b, sent=sent: _positives(b, *sent.value, dims, positives), "uid long, positive_id long, score long")
        best = W.partitionBy("uid").orderBy(F.desc("score"), "positive_id")
        near = cut(near.withColumn("k", F.row_number().over(best)).where(F.col("k") <= positives))
        sent.unpersist()
        sent = spark.sparkContext.broadcast((Anchors(mine, dims, near.collect()), book))
        far = pairs.mapInArrow(lambda b, sent=sent: _negatives(b, *sent.value, dims, negatives, low, high), "uid long, k long, positive_id long, positive_score long, negative_id long, negative_score long")
        best = W.partitionBy("uid", "k").orderBy(F.desc("negative_score"), "negative_id")
        found.append(cut(far.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)))
        sent.unpersist()
    real = lambda c: F.when(F.col(c) != _LAST, F.col(c)).alias(c)
    named = _union(found).join(chosen.select("uid", F.col("id").alias("anchor_id")), "uid")
    return named.select("anchor_id", real("positive_id"), "rank", real("negative_id"), "positive_score", "negative_score")
