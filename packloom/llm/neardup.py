"""MinHash near-dedup with SuperMinHash signatures, banding, verification on full shingle sets and union-find.

SuperMinHash walks a random permutation of the ``M`` slots for every shingle; the j-th slot of the walk gets j + r with r in [0, 1). The
slots of one walk differ, so that signatures vary less than with independent hashes; a walk stops early, once j passes the largest
slot value of its document. Here all shingles of a batch walk level by level, which gives the same signatures.

Steps: texts of equal word sequences (by a cryptographic digest of the words) are one class, by its smallest doc_id. ``BANDS`` bands of ``ROWS`` slots deal the
classes into buckets: a pair at similarity 0.75 shares none with probability 5e-6. First each class is held against one class, the bucket
minimum with which it shares most bands; links make components. Only buckets that still span components go on: each class outside the
component of the bucket's minimum is held against those of other components by sketches (a byte of each slot, and the parity of hash counts, which bounds how
many shingles differ), in blocks of bounded size, at first each with the three closest, then with all that the sketches can't rule out. What is done is in proportion to
a bucket's classes times those that the first step left outside its main component. Links always come from the full shingle sets of both texts, compared as words, never from
signatures or hashes alone. Only texts that share a bucket are moved, once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packloom.llm import _text
from packloom.llm._store import alone, cut, fresh
from packloom.llm.graph import components

WORDS = 5
PERCENT = 75
BANDS, ROWS = 32, 4
M = BANDS * ROWS
#: Of the ``M`` slots, a pair at similarity 0.75 agrees in 96 on average, with a deviation of 5; in fewer than this many, one pair of a million does.
AGREE = 73
#: Bits of the parity sketch: bit k tells whether an odd number of shingles hash to k.
PARITY = 2048
BLOCK = 1024
#: Elements whose permutations are held at once.
WALKERS = 1 << 18
#: Rows and bytes of text signed or compared at once.
BATCH = 256, 4 << 20
#: Rows of blocks compared at once, and more until their group ends.
GROUP_ROWS = 20_000
SIGNED = "doc_id long, n_shingles long, seq_a long, seq_b long, bands array<long>, sketch binary"
_U = np.uint64


def super_minhash(elements: np.ndarray, owner: np.ndarray, n_owners: int, m: int = M) -> np.ndarray:
    """Signatures (n_owners x m) of sets of 64-bit elements; a value is level << 32 | fraction. Owners without elements keep the largest value."""
    sig = np.full(n_owners * m, ~_U(0))
    for a in range(0, len(elements), WALKERS):  # a set's signature is the least of its parts'
        _walk(sig, elements[a : a + WALKERS], owner[a : a + WALKERS], m)
    return sig.reshape(n_owners, m)


def _walk(sig: np.ndarray, live: np.ndarray, who: np.ndarray, m: int) -> None:
    perm = None
    for j in range(m):
        if not len(live):
            break
        with np.errstate(over="ignore"):
            x = _text.mix(live + _U(j + 1) * _U(0x9E3779B97F4A7C15))
        k = j + (((x & _U(0xFFFFFFFF)) * _U(m - j)) >> _U(32)).astype(np.int64)
        if perm is None:
            slot = k
        else:
            i = np.arange(len(live))
            slot = perm[i, k].astype(np.int64)
            perm[i, k] = perm[:, j]
        np.minimum.at(sig, who * m + slot, (_U(j) << _U(32)) | (x >> _U(32)))
        done = sig.reshape(-1, m).max(1) < (_U(j + 1) << _U(32))
        stay = ~done[who]
        if perm is None:
            live, who, k = live[stay], who[stay], k[stay]
            perm = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(live), 1))
            perm[np.arange(len(live)), k] = 0
        elif not stay.all():
            live, who, perm = live[stay], who[stay], perm[stay]


def parity(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``PARITY`` bits for each set. Two sets' rows differ in no more bits than the sets differ in elements."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    bit = (_text.mix(np.concatenate(sets) ^ _U(0xA5A5A5A5)) % _U(PARITY)).astype(np.int64)
    return np.packbits((np.bincount(owner * PARITY + bit, minlength=len(sets) * PARITY) & 1).astype(np.uint8).reshape(len(sets), PARITY), axis=1)


def most_odd(both: np.ndarray) -> np.ndarray:
    """Differing parity bits above which sets of ``both`` elements together can't be linked.

    A link's sets differ in d <= both / 7 elements, and so in d bits at most, which rules out for certain. Of large sets
    many bits cancel out: they are ruled out six deviations above the number expected at the largest d.
    """
    d = both * (100 - PERCENT) / (100 + PERCENT)
    expected = PARITY / 2 * (1 - np.exp(-2 * d / PARITY))
    return np.minimum(d, expected + 6 * np.sqrt(PARITY / 4 * (1 - np.exp(-4 * d / PARITY))))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    salt = _text.mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    for whole in batches:
        for batch in _text.slices(whole, "text", *BATCH):
            words = _text.Words(batch.column("text"), lower=True)
            sets = _text.shingles(words.w, words.bounds, WORDS)
            sizes = np.array([len(s) for s in sets], np.int64)
            n = len(sets)
            sig = super_minhash(np.concatenate(sets), np.repeat(np.arange(n), sizes), n)
            with np.errstate(over="ignore"):
                b = sig.reshape(n, BANDS, ROWS)
                band = np.zeros((n, BANDS), np.uint64)
                for i in range(ROWS):
                    band = _text.mix(band * _U(0xD6E8FEB86659FD93) + b[:, :, i])
                band = _text.mix(band ^ salt)
                sketch = np.concatenate([(_text.mix(sig) & _U(255)).astype(np.uint8), parity(sets)], 1)
            digest = _digests(words)
            live = sizes > 0
            flat = pa.array(band[live].ravel().view(np.int64))
            ends = np.concatenate([[0], np.cumsum(live) * BANDS]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), pa.array(digest[:, 0]), pa.array(digest[:, 1]), pa.ListArray.from_arrays(pa.array(ends), flat), pa.array([x.tobytes() for x in sketch], pa.binary())],
                names=["doc_id", "n_shingles", "seq_a", "seq_b", "bands", "sketch"],
            )


def _digests(words: _text.Words) -> np.ndarray:
    """A 128-bit digest of each row's word sequence, as two longs."""
    raw, stop = words.spelled()
    raw, bounds = memoryview(raw), stop[words.bounds]
    found = b"".join(hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()))
    return np.frombuffer(found, "<i8").reshape(-1, 2)


def similar(u: pa.Array, v: pa.Array) -> list[bool]:
    """Whether the full shingle sets of each two texts are similar enough. Hashes decide only where no two different words or shingles of the batch share one; else the words do."""
    n, words = len(u), _text.Words(pa.concat_arrays([x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in (u, v)]), lower=True)
    if words.sound() and words.sound_sequences(_text.sequences(words.w, WORDS), WORDS):
        sets = _text.shingles(words.w, words.bounds, WORDS)
        counts = [(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)) for x, y in zip(sets[:n], sets[n:])]
    else:
        sets = [{tuple(w[i : i + WORDS]) for i in range(max(1, len(w) - WORDS + 1))} if w else set() for w in words.lists()]
        counts = [(len(x & y), len(x), len(y)) for x, y in zip(sets[:n], sets[n:])]
    return [both > 0 and 100 * both >= PERCENT * (x + y - both) for both, x, y in counts]


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of the distinct ``pairs`` (u, v), those whose full sets are similar enough."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _text.slices(whole, "text_u", *BATCH):  # similar texts are of similar lengths
                yield batch.select(["u", "v"]).filter(pa.array(similar(batch.column("text_u"), batch.column("text_v")), pa.bool_()))

    v = texts.select(F.col("doc_id").alias("v"), F.col("text").alias("text_v"))
    u = texts.select(F.col("doc_id").alias("u"), F.col("text").alias("text_u"))
    both = pairs.join(v, "v").join(u, "u").select("u", "v", "text_u", "text_v")
    return cut(both.mapInArrow(verify, "u long, v long").distinct())


def _apart(sketch: np.ndarray, size: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the pairs (x, y) their sketches don't rule out, and the share of parity bits in which these differ."""
    near, odd = np.zeros(len(x), bool), np.zeros(len(x), np.int64)
    bits = sketch[:, M:].view(np.uint64)
    for at in range(0, len(x), 1 << 15):
        a, b = x[at : at + (1 << 15)], y[at : at + (1 << 15)]
        some = np.flatnonzero(np.count_nonzero(sketch[a, :M] == sketch[b, :M], axis=1) >= AGREE)
        odd[at + some] = np.bitwise_count(bits[a[some]] ^ bits[b[some]]).sum(1, dtype=np.int64)
        near[at + some] = True
    at = np.flatnonzero(near)
    both = size[x[at]] + size[y[at]]
    ok = odd[at] <= most_odd(both)
    return at[ok], odd[at[ok]] / both[ok]


def _agreeing(slots: np.ndarray, comp: np.ndarray, rows: slice, cols: slice) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of two large blocks in different components whose sketches agree in enough slots."""
    x, y = [], []
    for i in range(rows.start, rows.stop, 256):
        part = slice(i, min(i + 256, rows.stop))
        agree = np.zeros((part.stop - i, cols.stop - cols.start), np.uint8)
        for slot in slots:
            agree += slot[part, None] == slot[None, cols]
        a, b = np.nonzero((agree >= AGREE) & (comp[part, None] != comp[None, cols]))
        x.append(a + i)
        y.append(b + cols.start)
    return np.concatenate(x), np.concatenate(y)


def _across(rows: pa.RecordBatch, closest: int) -> pa.RecordBatch:
    """Pairs between the two blocks of each group (or within its one) that lie in different components and that their sketches don't rule out; if ``closest``, so many at most for each
    member of the second block. Groups are whole and sorted by key, x, y and block."""
    ids, comp, block, size = (np.asarray(rows[c]) for c in ("id", "component", "block", "n_shingles"))
    group = [np.asarray(rows[c]) for c in ("key", "x", "y")]
    sketch = np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint8).reshape(len(ids), M + PARITY // 8)
    new = np.ones(len(ids), bool)
    new[1:] = np.any([g[1:] != g[:-1] for g in group], axis=0)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(ids))
    second = begin + np.add.reduceat((block != group[2]).astype(np.int64), begin)  # where the second block begins
    alone = group[1][begin] == group[2][begin]
    first_end = np.where(alone, end, second)
    a, b = end - second, first_end - begin
    small = a * b <= 1 << 16
    n = np.where(small, a * b, 0)
    of = np.repeat(np.arange(len(n)), n)
    k = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    x, y = second[of] + k // b[of], begin[of] + k % b[of]
    keep = (comp[x] != comp[y]) & (~alone[of] | (x > y))
    x, y = [x[keep]], [y[keep]]
    if not small.all():
        slots = np.ascontiguousarray(sketch[:, :M].T)
        for g in np.flatnonzero(~small).tolist():
            found = _agreeing(slots, comp, slice(int(second[g]), int(end[g])), slice(int(begin[g]), int(first_end[g])))
            x.append(found[0])
            y.append(found[1])
    x, y = np.concatenate(x), np.concatenate(y)
    at, apart = _apart(sketch, size, x, y)
    x, y = x[at], y[at]
    if closest:
        order = np.lexsort((ids[y], apart, x))
        x, y = x[order], y[order]
        rank = np.arange(len(x)) - np.searchsorted(x, x)
        x, y = x[rank < closest], y[rank < closest]
    pairs = np.stack([np.minimum(ids[x], ids[y]), np.maximum(ids[x], ids[y])], 1)
    pairs = np.unique(pairs, axis=0) if len(pairs) else pairs
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], names=["u", "v"])


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of whole groups (key, x, y)."""
    held, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < GROUP_ROWS:
            continue
        every = pa.concat_batches(held)
        same = np.all([(c := np.asarray(every[name])) == c[-1] for name in ("key", "x", "y")], axis=0)
        at = int(np.flatnonzero(~same).max(initial=-1)) + 1
        if at:
            yield every.slice(0, at)
        held, rows = [every.slice(at)], len(every) - at
    if held:
        yield pa.concat_batches(held)


def _candidates(members: DataFrame, known: DataFrame, comp: DataFrame, closest: int) -> DataFrame:
    """Pairs (u, v) across components within buckets.

    A bucket's main component is that of the smallest id. Its classes and the others are dealt into blocks; blocks of others meet all
    blocks, those of the main component never each other, and no group holds more than two blocks.
    """
    rows = cut(members.join(comp, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component")))
    mixed = rows.groupBy("key").agg(F.min("component").alias("main"), F.max("component").alias("last"), F.count(F.lit(1)).alias("n"))
    mixed = mixed.where("main < last").select("key", "main", "n")
    rows = rows.join(cut(mixed), "key")
    others = rows.where("component <> main").groupBy("key").agg(F.count(F.lit(1)).alias("m"))
    rows = rows.join(cut(others), "key")
    deal = lambda n: F.greatest(F.lit(1), F.ceil(n / BLOCK)).cast("int")
    rows = rows.withColumns({"i": deal(F.col("n") - F.col("m")), "j": deal(F.col("m")), "own": F.col("component") == F.col("main")})
    h = F.xxhash64("id")
    rows = rows.withColumn("block", F.when(F.col("own"), F.pmod(h, F.col("i"))).otherwise(F.col("i") + F.pmod(h, F.col("j"))).cast("int"))
    rows = rows.join(known, "id")
    rows = rows.withColumn("other", F.explode(F.sequence(F.when(F.col("own"), F.col("i")).otherwise(0), F.col("i") + F.col("j") - 1)))
    rows = rows.withColumns({"x": F.least("block", "other"), "y": F.greatest("block", "other")})
    rows = rows.select("key", "x", "y", "id", "component", "block", "n_shingles", "sketch")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_groups(batches):
            yield _across(batch, closest)

    dealt = rows.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "block")  # groups hold two blocks at most
    return dealt.mapInArrow(compare, "u long, v long").distinct()


@alone
def near_duplicates(docs: DataFrame) -> DataFrame:
    """Every row's doc_id, n_shingles, component_id (the smallest doc_id that links reach, itself included) and kept (doc_id = component_id).

    Links have 100 * intersection >= 75 * union of distinct 5-word shingles (words outside ASCII white space, A-Z lower-cased; fewer
    words: one shingle of all). Texts without words are linked with nothing. Rows of one doc_id are one node. A row with a null doc_id
    is linked with nothing: its component_id is null and it is kept. Very long texts are signed and compared whole, some 20 bytes of memory a byte. An empty table gives no rows; other columns don't matter.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = cut(docs.mapInArrow(_sign, SIGNED))
    alive = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = alive.groupBy("seq_a", "seq_b").agg(F.min(F.struct("doc_id", "n_shingles", "bands", "sketch")).alias("r"), F.count(F.lit(1)).alias("n"))
    classes = cut(classes.select("seq_a", "seq_b", "n", F.col("r.doc_id").alias("id"), "r.n_shingles", "r.bands", "r.sketch"))
    copies = cut(classes.where("n > 1").select("seq_a", "seq_b", F.col("id").alias("u")))
    member = alive.select("seq_a", "seq_b", F.col("doc_id").alias("v")).join(copies, ["seq_a", "seq_b"])
    member = cut(member.where("u <> v").select("u", "v"))
    banded = classes.select("id", F.explode("bands").alias("key"))
    buckets = cut(banded.groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("last")).where("pivot < last").select("key", "pivot"))
    members = cut(banded.join(buckets, "key"))
    near = cut(members.select("id").distinct())  # only these can have links
    known = cut(classes.select("id", "n_shingles", "sketch").join(near, "id", "left_semi"))
    texts = cut(docs.join(near.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi"))

    shared = members.where("id <> pivot").groupBy("id", "pivot").agg(F.count(F.lit(1)).alias("n"))
    best = shared.groupBy("id").agg(F.max(F.struct("n", (-F.col("pivot")).alias("p"))).alias("b"))
    pairs = tried = cut(best.select((-F.col("b.p")).alias("u"), F.col("id").alias("v")))
    links = _links(pairs, texts)
    members = members.select("key", "id")
    for closest in (3, 0):
        comp = cut(components(links))
        pairs = cut(_candidates(members, known, comp, closest).join(tried, ["u", "v"], "left_anti"))
        tried = tried.unionByName(pairs)
        links = cut(links.unionByName(_links(pairs, texts)))
    comp = cut(components(links.unionByName(member)))
    rows = signed.select("doc_id", "n_shingles").join(comp, F.col("doc_id") == F.col("id"), "left")
    component = F.coalesce("component", "doc_id")
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def without_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group: that with the smallest doc_id. Rows of a null doc_id all stay.

    Rows that share the doc_id that stays all stay, whatever their texts: they are one document.
    """
    name = fresh(docs, "gone")
    gone = near_duplicates(docs).where("NOT kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == F.col(name), "left_anti")
