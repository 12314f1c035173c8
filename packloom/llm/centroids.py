"""Centroid clustering by Elkan's bounds, on integer vectors.

Each vector keeps its centroid, an upper bound on the distance to it and a lower bound on the distance to each centroid. A centroid is skipped where
the upper bound is strictly below the vector's lower bound for it, or strictly below half the distance between it and the vector's own one; a vector
whose upper bound is below half the distance to the nearest other centroid is skipped altogether. Bounds are square roots rounded outwards,
so that a skipped centroid is farther, never as near: ties are always compared, on exact integer distances. When centroids have moved, bounds move by as much.

A round is one pass: tasks read the vectors with their bounds and write them anew, and one row a partition of the changes in the centroids' sums, which
only vectors that changed their centroid add to. Spark adds these up; the driver sees centroids x dimensions numbers. A written round is kept until the next one is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packloom.llm._store import alone, remove_dir, table
from packloom.llm._vectors import lists, matrix, sound, whole
from packloom.ship import ship

DIMS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
#: Vectors whose distances are computed at once.
CHUNK = 4096
#: A root is off by less than one part in 2**52; sums of bounds by as much again.
_UP, _DOWN = 1 + 2.0**-48, 1 - 2.0**-48


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to ``c``, one row or one for each."""
    out = np.empty(len(x), np.int64)
    for a in range(0, len(x), CHUNK):
        d = x[a : a + CHUNK].astype(np.int64) - (c if c.ndim == 1 else c[a : a + CHUNK])
        out[a : a + CHUNK] = (d * d).sum(1)
    return out


def upper(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64)) * _UP


def lower(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64)) * _DOWN


class Round:
    """What a round's tasks need: the centroids, half the distances between them, and how far each has moved since the bounds were kept."""

    def __init__(self, centroids: np.ndarray, before: np.ndarray | None = None):
        self.c, k = centroids, len(centroids)
        self.half = np.stack([lower(squared(centroids, c)) / 2 for c in centroids])
        other = self.half.copy()
        other[np.arange(k), np.arange(k)] = np.inf
        self.near = other.min(1)
        self.moved = upper(squared(centroids, before)) if before is not None else np.zeros(k)

    def assign(self, x: np.ndarray, own: np.ndarray, up: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Each vector's nearest centroid (of equally near ones the first), the new bounds, and the number of distances computed."""
        up = (up + self.moved[own]) * _UP
        low = np.maximum(low - self.moved, 0) * _DOWN
        todo = np.flatnonzero(up >= self.near[own])
        x, a, low_t = x[todo], own[todo], low[todo]
        best = squared(x, self.c[a])
        up_t = upper(best)
        low_t[np.arange(len(a)), a] = lower(best)
        done = len(a)
        for j in range(len(self.c)):
            some = np.flatnonzero((a != j) & (up_t >= low_t[:, j]) & (up_t >= self.half[a, j]))
            d = squared(x[some], self.c[j])
            done += len(some)
            low_t[some, j] = lower(d)
            nearer = (d < best[some]) | ((d == best[some]) & (j < a[some]))
            some, d = some[nearer], d[nearer]
            a[some], best[some], up_t[some] = j, d, upper(d)
        own, up = own.copy(), up.copy()
        own[todo], up[todo], low[todo] = a, up_t, low_t
        return own, up, low, done


def _sums(x: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """By centroid: the sum of its vectors, and their number."""
    return np.stack([np.append(x[own == j].sum(0, dtype=np.int64), (own == j).sum()) for j in range(k)])


def _passed(vectors: DataFrame, now: Round, dims: int, first: bool) -> DataFrame:
    """The vectors with new centroids and bounds; rows without a vector hold a partition's changes in the centroids' sums and numbers."""
    ship(vectors.sparkSession)
    k = len(now.c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = np.zeros((k, dims + 1), np.int64)
        kind = None
        for batch in batches:
            n, kind = batch.num_rows, batch.schema.field("vec_id").type
            if not n:
                continue
            x = matrix(batch.column("v"), dims, np.int32)
            if first:
                was, up, low = np.zeros(n, np.int64), np.full(n, np.inf), np.zeros((n, k))
            else:
                was, up, low = np.asarray(batch.column("own")).astype(np.int64), np.asarray(batch.column("up")), matrix(batch.column("low"), k, np.float64)
            own, up, low, _ = now.assign(x, was, up, low)
            if first:
                part += _sums(x, own, k)
            else:
                went = own != was
                part += _sums(x[went], own[went], k) - _sums(x[went], was[went], k)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(own.astype(np.int32)), pa.array(up), lists(low), pa.nulls(n, pa.list_(pa.int64()))], names=["vec_id", "v", "own", "up", "low", "part"])
        if kind is not None:
            cols = [pa.nulls(1, t) for t in (kind, pa.list_(pa.int32()), pa.int32(), pa.float64(), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*cols, lists(part.reshape(1, -1))], names=["vec_id", "v", "own", "up", "low", "part"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec_id {kind}, v array<int>, own int, up double, low array<double>, part array<long>")


def _added(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of all partitions' rows of ``size`` numbers."""
    out = np.zeros(size, object)
    for r in parts.select(F.posexplode("part").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect():
        out[r.i] = r.x
    return out


def _ended(vectors: DataFrame, last: Round, dims: int) -> DataFrame:
    """vec_id, cluster and distance; rows without a cluster hold a partition's distances by cluster."""
    k = len(last.c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, kind = np.zeros(k, np.int64), None
        for batch in batches:
            n, kind = batch.num_rows, batch.schema.field("vec_id").type
            if not n:
                continue
            x = matrix(batch.column("v"), dims, np.int32)
            own, _, _, _ = last.assign(x, np.asarray(batch.column("own")).astype(np.int64), np.asarray(batch.column("up")), matrix(batch.column("low"), k, np.float64))
            d = squared(x, last.c[own])
            np.add.at(part, own, d)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(own.astype(np.int32)), pa.array(d), pa.nulls(n, pa.list_(pa.int64()))], names=["vec_id", "cluster", "distance", "part"])
        if kind is not None:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()), lists(part.reshape(1, -1))], names=["vec_id", "cluster", "distance", "part"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec_id {kind}, cluster int, distance long, part array<long>")


@alone
def cluster(embeddings: DataFrame, dims: int = DIMS, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256 of every vector of ``embedding`` that has ``dims`` components, all finite numbers.

    Components are floor(scale * x). The first centroids are the vectors whose sha256 of ``seed:vec_id`` is smallest, fewer where there are fewer vectors;
    vectors without vec_id are clustered but start no centroid. Null vectors, those of other lengths and with null or non-finite components take no part. Repeated rows
    count apart, each of them may start a centroid. Of equally near centroids the first is taken. A component whose distances wouldn't fit a long fails. Without any
    vector that can start, there are no rows. Other columns don't matter.
    """
    most = int((2**62 // dims) ** 0.5) // 2
    rows = embeddings.where((F.size("embedding") == dims) & sound("embedding")).select("vec_id", whole("embedding", scale, most).alias("v"))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    starts = rows.where("vec_id IS NOT NULL").orderBy(order, "v").limit(clusters).collect()
    if not starts:
        kind = embeddings.schema["vec_id"].dataType.simpleString()
        return embeddings.sparkSession.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    c = np.array([r.v for r in starts], np.int64)
    k, sums, now, kept, folder = len(c), np.zeros((len(c), dims + 1), object), Round(c), rows, None
    for i in range(rounds):
        out, new = table(_passed(kept, now, dims, i == 0), "round")
        if folder:
            remove_dir(folder)
        sums, folder = sums + _added(out.where("own IS NULL"), k * (dims + 1)).reshape(k, -1), new
        before, c = c, np.array([[s // row[-1] for s in row[:-1]] if row[-1] else old for row, old in zip(sums.tolist(), c.tolist())], np.int64)
        kept, now = out.where("own IS NOT NULL"), Round(c, before)
    if not rounds:
        kept = table(_passed(rows, now, dims, True), "round")[0].where("own IS NOT NULL")
    ended = table(_ended(kept, now, dims), "ended")[0]
    inertia = [int(x) for x in _added(ended.where("cluster IS NULL"), k)]
    shas = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in c.tolist()]
    of = lambda values, kind: F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster") + 1)
    result = ended.where("cluster IS NOT NULL")
    return result.select("vec_id", "cluster", "distance", of(inertia, "long").alias("cluster_inertia"), F.lit(sum(inertia)).cast("long").alias("inertia"), of(shas, "string").alias("centroid_sha256"))
