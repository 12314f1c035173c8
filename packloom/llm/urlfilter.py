"""URL filters: host and path rules, then a Bloom filter cascade that decides exactly which keys are listed.

A cascade is built over a complete universe of keys. Level 1 encodes the listed keys; level 2 the unlisted
keys that level 1 lets pass; level 3 the listed keys that level 2 lets pass, and so on until nothing
passes wrongly. A key's verdict is the parity of the first level that lacks it, which is exact for every
key of the universe. Keys are dealt by hash into shards of bounded size, each with a cascade of its own, built
in one task. The shards' bytes are carried to the rows by broadcast in passes of at most ``pass_bytes``, so
that no pass carries more than that, however long the list grows; rows never join with the list.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packloom.llm._store import cut
from packloom.llm._text import mix

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
SEED = 0x5BD1E995


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or without ``://``: empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; null or without ``://``: empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (as ``host`` + ``path``) and its verdict; null where none fits."""
    name = verdict = None
    for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    return (F.lit(None).cast("string"),) * 2 if name is None else (name, verdict)


def _bits(a: np.ndarray, b: np.ndarray, level: int, m: int, k: int) -> np.ndarray:
    """k bit positions below m for every key (a, b); one row a key."""
    with np.errstate(over="ignore"):
        h = mix(a + np.uint64(level) * np.uint64(0x9E3779B97F4A7C15))
        g = mix(b ^ (np.uint64(level) * np.uint64(0xC2B2AE3D27D4EB4F))) | np.uint64(1)
        return (h[:, None] + np.arange(k, dtype=np.uint64) * g[:, None]) % np.uint64(m)


def build_cascade(listed: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray], bits_a_key: float = 8.0) -> bytes:
    """The levels' bit arrays, each after its length in bits and its number of hashes."""
    inside, outside, levels, level = listed, other, [], 1
    while len(inside[0]):
        m = max(64, int(len(inside[0]) * bits_a_key) + 7 & ~7)
        k = max(1, round(bits_a_key * 0.69))
        bits = np.zeros(m, bool)
        bits[_bits(*inside, level, m, k).ravel()] = True
        passed = bits[_bits(*outside, level, m, k)].all(1) if len(outside[0]) else np.zeros(0, bool)
        levels += [np.array([m, k], np.uint32).tobytes(), np.packbits(bits).tobytes()]
        inside, outside = (outside[0][passed], outside[1][passed]), inside
        level += 1
        if level > 200:
            raise ValueError("two keys of the universe have the same two hashes")
    return b"".join(levels)


def in_cascade(blob: bytes, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each key is listed: the first level that lacks it is an even one, or the last level is odd and has it."""
    out, at, level = np.zeros(len(a), bool), 0, 1
    alive = np.arange(len(a))
    while at < len(blob):
        m, k = np.frombuffer(blob, np.uint32, 2, at).tolist()
        bits = np.unpackbits(np.frombuffer(blob, np.uint8, m // 8, at + 8)).astype(bool)
        at += 8 + m // 8
        has = bits[_bits(a[alive], b[alive], level, m, k)].all(1)
        out[alive[~has]] = level % 2 == 0
        alive = alive[has]
        out[alive] = level % 2 == 1
        level += 1
    return out


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(F.lit(SEED), key)


def cascade_shards(universe: DataFrame, keys_a_shard: int = 1_000_000) -> DataFrame:
    """Of ``universe`` (key string, listed boolean; a key is listed if any of its rows is), one row a shard: shard, n_shards, blob.

    Null keys are no keys. A universe without listed keys gives empty blobs; an empty universe no row.
    """
    keys = universe.where(F.col("key").isNotNull()).groupBy("key").agg(F.max("listed").alias("listed"))
    a, b = _hashes(F.col("key"))
    keys = cut(keys.select(a.alias("a"), b.alias("b"), F.coalesce("listed", F.lit(False)).alias("listed")))
    n = max(1, -(-keys.count() // keys_a_shard))

    def build(table: pa.Table) -> pa.Table:
        a, b = (np.asarray(table[c]).view(np.uint64) for c in "ab")
        on = np.asarray(table["listed"])
        blob = build_cascade((a[on], b[on]), (a[~on], b[~on]))
        return pa.table({"shard": pa.array([table["shard"][0].as_py()], pa.int64()), "n_shards": pa.array([n], pa.int64()), "blob": pa.array([blob], pa.binary())})

    return keys.withColumn("shard", F.pmod("b", F.lit(n))).groupBy("shard").applyInArrow(build, "shard long, n_shards long, blob binary")


def listed_by_cascade(rows: DataFrame, key: str, shards: DataFrame, out: str, pass_bytes: int = 64 << 20) -> DataFrame:
    """``rows`` with a boolean column ``out``: whether ``key`` is listed. Exact for keys of the cascades' universe; null keys are not listed."""
    spark = rows.sparkSession
    shards = cut(shards)
    sizes = sorted((r.shard, r.n_shards, r.size) for r in shards.select("shard", "n_shards", F.length("blob").alias("size")).collect())
    passes: list[list[int]] = []
    room = 0
    for shard, _, size in sizes:
        if not passes or room + size > pass_bytes:
            passes.append([])
            room = 0
        passes[-1].append(shard)
        room += size
    n = sizes[0][1] if sizes else 1
    a, b = _hashes(F.col(key))
    names = list(rows.columns)
    rows = rows.withColumns({"__a": F.when(F.col(key).isNotNull(), a), "__b": b, out: F.lit(False)})
    for i, some in enumerate(passes):
        if i:  # a pass ends before the next one's bytes are carried out
            rows = cut(rows)
        blobs = spark.sparkContext.broadcast({r.shard: bytes(r.blob) for r in shards.where(F.col("shard").isin(some)).collect()})

        def look(batches: Iterator[pa.RecordBatch], blobs=blobs) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                valid = np.asarray(batch.column("__a").is_valid())
                a = np.asarray(batch.column("__a").fill_null(0)).view(np.uint64)
                b = np.asarray(batch.column("__b")).view(np.uint64)
                shard = np.mod(b.view(np.int64), n)
                hit = np.asarray(batch.column(out)).copy()
                for s, blob in blobs.value.items():
                    i = np.flatnonzero((shard == s) & valid)
                    if len(i):
                        hit[i] |= in_cascade(blob, a[i], b[i])
                yield batch.set_column(batch.schema.get_field_index(out), out, pa.array(hit))

        rows = rows.mapInArrow(look, rows.schema)
    return rows.select(*names, out)


def judge_urls(pages: DataFrame, listed_hosts: DataFrame | None = None, rules=RULES) -> DataFrame:
    """Each page's host, path, rule and verdict: the longest rule's, else block if the host is listed, else allow.

    ``listed_hosts`` has a column ``host``; by default the listed hosts are those whose every page came
    without TLS (no https url). Null urls and urls without ``://`` have an empty host and path, no rule, and
    the host is never listed. Very long urls are judged whole. Repeated rows are judged alike; an empty table gives no rows; further columns of ``pages`` are dropped.
    """
    rows = pages.select("page_id", "url").withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url"))})
    hosts = rows.where("host <> ''")
    if listed_hosts is None:
        tls = F.translate(F.substring("url", 1, 8), UPPER, LOWER) == "https://"
        universe = hosts.groupBy(F.col("host").alias("key")).agg((F.max(tls.cast("int")) == 0).alias("listed"))
    else:
        mine = listed_hosts.select(F.col("host").alias("key"), F.lit(True).alias("listed")).where("key <> ''")
        universe = hosts.select(F.col("host").alias("key"), F.lit(False).alias("listed")).distinct().union(mine)
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = listed_by_cascade(rows.select("page_id", "host", "path"), "host", cascade_shards(universe), "listed")
    by_list = F.when(F.col("listed"), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, by_list).alias("verdict"), "listed")
