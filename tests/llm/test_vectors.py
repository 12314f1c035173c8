"""Clustering and hard negatives against brute force, with nulls, odd lengths, ties, repeated rows, empty tables and columns of clashing names."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from packloom.llm import centroids, negatives
from packloom.llm._vectors import matrix

SCHEMA = "vec_id long, embedding array<float>, label int, v string, own string, uid string, id string, code string, `rank` string, cluster string"


def make_vectors(dims=64, n=220):
    rnd = random.Random(11)
    centers = [[rnd.gauss(0, 0.3) for _ in range(dims)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = centers[rnd.randrange(6)]
        rows.append((i, [float(np.float32(x + rnd.gauss(0, 0.1))) for x in c], rnd.randrange(4)))
    rows += [(i, rows[7][1], rows[7][2]) for i in range(300, 340)]  # one common vector
    rows += [rows[50], rows[50], rows[100], (400, [0.0] * dims, 1), (401, [0.0] * dims, 2), (None, rows[3][1], 1), (None, rows[3][1], 2)]
    rows += [(500, None, 1), (501, rows[0][1], None), (502, [None] + rows[0][1][1:], 1), (503, [float("nan")] + rows[0][1][1:], 2), (504, [float("-inf")] + rows[0][1][1:], 2), (450, [], 3), (550, rows[9][1][:-1], 1)]
    return [(*r, *"abcdefg") for r in rows]


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(make_vectors(), SCHEMA).repartition(5).cache()


def good(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute_clusters(rows, k=8, rounds=10):
    kept = [(r[0], [math.floor(1024 * x) for x in r[1]]) for r in rows if good(r[1]) and len(r[1]) == 64]
    c = [v for _, _, v in sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), i, v) for i, v in kept if i is not None)[:k]]
    dist = lambda v, x: sum((a - b) ** 2 for a, b in zip(v, x))
    near = lambda v: min((dist(v, x), j) for j, x in enumerate(c))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for j in range(len(c)):
            if mine := [v for (_, v), o in zip(kept, own) if o == j]:
                c[j] = [sum(x) // len(mine) for x in zip(*mine)]
    out = [(i, near(v)[1], near(v)[0]) for i, v in kept]
    by = [sum(d for _, o, d in out if o == j) for j in range(len(c))]
    sha = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c]
    return sorted((str(i), o, d, by[o], sum(by), sha[o]) for i, o, d in out)


def told(df):
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def test_clusters(spark, vectors):
    rows = make_vectors()
    assert told(centroids.cluster(vectors)) == brute_clusters(rows)
    assert told(centroids.cluster(vectors, rounds=0)) == brute_clusters(rows, rounds=0)
    few = spark.createDataFrame(rows[:3], SCHEMA)
    assert told(centroids.cluster(few)) == brute_clusters(rows[:3])
    assert centroids.cluster(few.limit(0)).columns == centroids.cluster(few).columns and not centroids.cluster(few.limit(0)).count()
    assert not centroids.cluster(spark.createDataFrame([(None, [0.0] * 64, 1, *"abcdefg")], SCHEMA)).count()
    with pytest.raises(Exception, match="is beyond"):
        centroids.cluster(spark.createDataFrame([(1, [1e9] * 64, 1, *"abcdefg")], SCHEMA)).collect()


def test_bounds_skip_distances_and_keep_ties():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.integers(-3, 4, (400, 2)), rng.integers(40, 47, (400, 2))]).astype(np.int32)  # many equal distances
    c = np.array([[0, 0], [0, 2], [2, 0], [43, 43], [43, 45], [45, 43], [500, 500]])
    own, up, low, before, most = np.zeros(len(x), np.int64), np.full(len(x), np.inf), np.zeros((len(x), len(c))), None, len(x) * len(c)
    for i in range(6):
        own, up, low, done = centroids.Round(c, before).assign(x, own, up, low)
        d = np.stack([centroids.squared(x, q) for q in c], 1)
        assert (own == d.argmin(1)).all()
        assert (up >= np.sqrt(d[np.arange(len(x)), own])).all() and (low <= np.sqrt(d)).all()
        assert done < (most if i == 0 else most / 2)
        before, c = c, np.array([x[own == j].sum(0) // max(1, (own == j).sum()) if (own == j).any() else c[j] for j in range(len(c))])


def brute_negatives(rows, div=50, positives=5, n=3):
    live = [(u, r[0], r[2], [math.floor(256 * x) for x in r[1]]) for u, r in enumerate(rows) if r[2] is not None and good(r[1])]
    key = lambda i: 2**63 if i is None else i
    out = []
    for _, i, label, v in live:
        if i is None or i % div:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), key(j), x) for _, j, x, w in live if j != i or x != label)
        mine = [(-s, j) for s, j, x in scored if x == label][:positives]
        for s, j in mine:
            found = [(-t, k) for t, k, x in scored if x != label and 50 * s <= -100 * t <= 95 * s][:n]
            out += [(i, j, rank + 1, k, s, t) for rank, (t, k) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("how", [{}, {"block_bytes": 600}, {"block_bytes": 1 << 20}])
def test_hard_negatives(spark, vectors, how, monkeypatch):
    if how.get("block_bytes", 0) > 600:
        monkeypatch.setattr(negatives, "ROWS", 7)
        monkeypatch.setattr(negatives, "ANCHORS", 2)
    got = negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0, **how).collect()
    key = lambda i: 2**63 if i is None else i
    assert sorted((r.anchor_id, key(r.positive_id), r["rank"], key(r.negative_id), r.positive_score, r.negative_score) for r in got) == brute_negatives(make_vectors())


def test_hard_negatives_of_little(spark, vectors):
    assert not negatives.hard_negatives(vectors.limit(0), F.col("vec_id") % 50 == 0).count()
    assert not negatives.hard_negatives(vectors.where("vec_id = 450"), F.col("vec_id") % 50 == 0).count()
    assert not negatives.hard_negatives(vectors, F.lit(None).cast("boolean")).count()
    with pytest.raises(Exception, match="is beyond"):
        negatives.hard_negatives(spark.createDataFrame([(50, [1e9], 1, *"abcdefg")], SCHEMA), F.lit(True)).collect()


def test_bounds_hold():
    rng = np.random.default_rng(5)
    v = rng.integers(-200, 200, (900, 19)).astype(np.int32)
    v[::9] = v[0]
    book = negatives.Codebook(v[:300].astype(np.int64), 19)
    codes, norms = book.encode(v)
    low, high = negatives.bounds(codes, norms, *book.tables(v[:40]))
    exact = v.astype(np.int64) @ v[:40].T.astype(np.int64)
    assert (low <= exact).all() and (exact <= high).all()
    r, c = np.nonzero(high >= np.sort(exact, 0)[-5])
    assert len(r) < 0.6 * exact.size and (negatives.scores(v, v[:40], r, c) == exact[r, c]).all()
    assert (negatives.scores(v, v[:40], r[:9], c[:9]) == exact[r[:9], c[:9]]).all()


def test_matrix_fills_short_vectors():
    import pyarrow as pa

    got = matrix(pa.array([[1, 2], [], [3]], pa.list_(pa.int32())).slice(0), 2)
    assert got.tolist() == [[1, 2], [0, 0], [3, 0]]
