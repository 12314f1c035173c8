"""Substring dedup on the De Bruijn graph of word k-mers: later copies of long spans are cut out.

The graph's nodes are the windows of ``span`` words, its edges the k-mers of span + 1 words that lead from each window to the next one.

1. Pieces. Each window has an anchor: of the ``ANCHOR``-word sequences in it the one that a hash ranks first, so that equal windows have
   equal anchors. The consecutive windows of a text that share one anchor occurrence are a piece, the row that Spark moves (about one for each eight
   windows). A piece whose words an earlier one of its batch has too, word for word, goes at once and is not compared any further, so
   that a passage in a third of all documents costs a row a batch. Pieces of anchors that a sample shows to be hot are single windows, dealt by their own hashes.
2. Nodes. Pieces meet at their anchor, sorted, and are read as a stream. Windows that occur more than once are nodes; where one's occurrences are all followed by
   the same node and this one's all preceded by it (out-degree and in-degree one), the two are joined to a segment.
3. Paths. Segments end where pieces do. A join of their occurrences by source coordinates finds which follow each other, again with degrees of one; joins by
   pointer doubling compact such chains to paths without branches.
4. Spans. Each path has the same windows wherever it occurs. All occurrences but that of the smallest source coordinates (doc_id, start) go. A join takes them to
   the texts. A digest of the words at each occurrence is compared with that at the others: where two differ, window hashes have
   collided, and all is done again with other hashes. The words that spans cover are cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packloom.llm import _text
from packloom.llm._store import alone, cut, table
from packloom.ship import ship

SPAN = 20
ANCHOR = 6
#: Bytes kept of a window's hash; windows are only compared under one 64-bit anchor.
HASH_BYTES = 7
#: Documents and bytes of text cut up at once.
BATCH = 1500, 6 << 20
#: One document of so many is looked at for hot anchors; those with at least so many windows among them are, but for more than so many anchors in all.
SAMPLE, HOT_ROWS, HOT_ANCHORS = 32, 512, 65_536
#: Pieces read at once, and more until the anchor changes.
CHUNK_ROWS = 120_000
ATTEMPTS = 5
_LAST = 2**63 - 1
PIECE = "key long, doc long, th long, start long, n int, windows binary"
SEGMENT = "seg long, doc long, th long, begin long, len long, n long, first boolean"
_U = np.uint64
_PLACE = _U((1 << 28) - 1)


def _split(words: _text.Words, span: int, seed: int) -> tuple[np.ndarray, ...] | None:
    """Of all windows within rows: their first words, rows and hashes; and of all pieces: their first windows (places among the windows), numbers of windows and anchors' hashes."""
    w, counts = words.w, np.diff(words.bounds)
    if seed:
        w = _text.mix(w ^ _text.mix(np.array([seed], np.uint64)))
    if len(w) < span:
        return None
    row = np.repeat(np.arange(len(counts)), counts)
    window = _text.sequences(w, span)
    ok = row[: len(window)] == row[span - 1 :]
    if not ok.any():
        return None
    small = _text.sequences(w, ANCHOR)
    width = span - ANCHOR + 1
    low = (small & ~_PLACE) | (np.arange(len(small), dtype=np.uint64) & _PLACE)
    size = 1
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    low = np.minimum(low[: len(window)], low[width - size : width - size + len(window)])
    at = np.flatnonzero(ok)
    anchor = (low[at] & _PLACE).astype(np.int64) | (at & ~int(_PLACE))
    anchor[anchor < at] += int(_PLACE) + 1
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]])
    first = np.flatnonzero(new)
    return at, row[at], window[at], first, np.diff(np.append(first, len(at))), small[anchor[first]]


def _pieces(batch: pa.RecordBatch, span: int, seed: int, hot: np.ndarray) -> pa.RecordBatch | None:
    """The batch's pieces. Those that go have no windows and a key of no meaning; such that follow each other are one row."""
    words = _text.Words(batch.column("text"), lower=False)
    if (found := _split(words, span, seed)) is None:
        return None
    at, row, window, first, n, key = found
    if len(hot):
        near = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
        alone = np.repeat(hot[near] == key, n)
        whole = np.zeros(len(at), bool)
        whole[first] = True
        key = np.repeat(key, n)
        key = np.where(alone, _text.mix(key ^ window), key)
        first = np.flatnonzero(whole | alone)
        n, key = np.diff(np.append(first, len(at))), key[first]
    doc, th = (np.asarray(batch.column(c))[row[first]] for c in ("doc", "th"))
    start = at[first] - words.bounds[row[first]]
    inner = np.arange(len(at)) - np.repeat(first, n)
    with np.errstate(over="ignore"):
        content = _text.mix(np.add.reduceat(_text.mix(window ^ _text.mix(inner.astype(np.uint64))), first) + n.astype(np.uint64)) ^ key
    order = np.lexsort((start, doc, content))
    same = np.zeros(len(order), bool)
    same[1:] = content[order[1:]] == content[order[:-1]]
    head = np.empty(len(order), np.int64)
    head[order] = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
    gone = np.flatnonzero((head != np.arange(len(head))) & ((doc != doc[head]) | (start != start[head])) & (n == n[head]))
    if len(gone):  # word for word
        size = n[gone] + span - 1
        ends = np.cumsum(size)
        inside = np.arange(int(ends[-1])) - np.repeat(ends - size, size)
        differ = words.w[np.repeat(at[first[gone]], size) + inside] != words.w[np.repeat(at[first[head[gone]]], size) + inside]
        gone = gone[~np.logical_or.reduceat(differ, ends - size)] if words.sound() else gone[:0]
    stay = np.ones(len(n), bool)
    stay[gone] = False
    raw = window.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES]
    raw = np.ascontiguousarray(raw[np.repeat(stay, n)]).tobytes()
    of, place = row[first], at[first]
    on = np.zeros(len(n), bool)  # goes, right behind another one that does: they are one row
    on[1:] = ~stay[1:] & ~stay[:-1] & (of[1:] == of[:-1]) & (place[1:] == place[:-1] + n[:-1])
    lead = np.flatnonzero(~on)
    n, stay, key, doc, th, start = np.add.reduceat(n, lead), stay[lead], key[lead], doc[lead], th[lead], start[lead]
    ends = np.concatenate([[0], np.cumsum(np.where(stay, n, 0))]) * HASH_BYTES
    with np.errstate(over="ignore"):
        spread = _text.mix(doc.view(np.uint64) ^ th.view(np.uint64))
    data = pa.Array.from_buffers(pa.binary(), len(n), [pa.array(stay).buffers()[1], pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(raw)])
    return pa.RecordBatch.from_arrays([pa.array(np.where(stay, key, spread).view(np.int64)), pa.array(doc), pa.array(th), pa.array(start), pa.array(n.astype(np.int32)), data], names=[x.split()[0] for x in PIECE.split(", ")])


def _segments(rows: pa.RecordBatch) -> pa.RecordBatch | None:
    """The segments' occurrences among whole groups of pieces, sorted by anchor, doc, start and th; pieces that went pass as segments of no path."""
    key, doc, th, start, n = (np.asarray(rows[c]) for c in ("key", "doc", "th", "start", "n"))
    windows = rows["windows"]
    stay = np.asarray(windows.is_valid())
    out = [[np.zeros(int((~stay).sum()), np.int64), doc[~stay], th[~stay], start[~stay], n[~stay].astype(np.int64), np.zeros(int((~stay).sum()), np.int64)]]
    live = np.flatnonzero(stay)
    again = np.ones(len(live), bool)  # rows of one doc_id and text count once
    again[1:] = np.any([x[live[1:]] != x[live[:-1]] for x in (key, doc, start, th)], axis=0)
    live = live[again]
    shared = np.zeros(len(live), bool)
    twin = key[live[1:]] == key[live[:-1]]
    shared[1:] |= twin
    shared[:-1] |= twin
    live = live[shared]
    if len(live):
        doc, th, start, key, n = doc[live], th[live], start[live], key[live].view(np.uint64), n[live].astype(np.int64)
        kept = windows.take(pa.array(live))
        raw = np.frombuffer(kept.buffers()[2], np.uint8, int(n.sum()) * HASH_BYTES).reshape(-1, HASH_BYTES)
        full = np.zeros((len(raw), 8), np.uint8)
        full[:, :HASH_BYTES] = raw
        owner = np.repeat(np.arange(len(n)), n)
        head = np.cumsum(n) - n
        hashes = _text.mix(full.view("<u8").ravel() ^ _text.mix(key)[owner])
        order = np.argsort(hashes, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = hashes[order[1:]] != hashes[order[:-1]]
        begins = np.flatnonzero(new)
        node = np.empty(len(order), np.int64)
        node[order] = np.cumsum(new) - 1
        count = np.diff(np.append(begins, len(order)))

        def only(beside: np.ndarray) -> np.ndarray:
            """Of each node the one that its occurrences all have beside them; -1 without one."""
            least, most = np.minimum.reduceat(beside[order], begins), np.maximum.reduceat(beside[order], begins)
            return np.where(least == most, least, -1)

        after, before = np.full(len(node), -1), np.full(len(node), -1)
        inside = np.ones(len(node), bool)
        inside[head] = False  # has a window of its piece before it
        before[inside] = node[np.flatnonzero(inside) - 1]
        after[np.flatnonzero(inside) - 1] = node[inside]
        following, leading = only(after), only(before)
        joined = inside.copy()
        joined[inside] = (following[before[inside]] == node[inside]) & (leading[node[inside]] == before[inside])
        twice = count[node] > 1
        opens = np.flatnonzero(twice & ~joined)
        breaks = np.flatnonzero(~twice | ~joined)  # a segment lasts to the next one
        breaks = np.append(breaks, len(node))
        length = breaks[np.searchsorted(breaks, opens, "right")] - opens
        place = start[owner] + np.arange(len(owner)) - head[owner]
        source = order[begins][node[opens]]
        of = owner[opens]
        is_first = (doc[of] == doc[owner[source]]) & (place[opens] == place[source])
        out.append([hashes[opens].view(np.int64), doc[of], th[of], place[opens], length, np.where(is_first, -1, 1) * count[node[opens]]])
    seg, doc, th, begin, length, count = (np.concatenate(x) for x in zip(*out))
    if not len(seg):
        return None
    return pa.RecordBatch.from_arrays([pa.array(seg), pa.array(doc), pa.array(th), pa.array(begin), pa.array(length), pa.array(np.abs(count)), pa.array(count < 0)], names=[x.split()[0] for x in SEGMENT.split(", ")])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches that end where the anchor changes."""
    held, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < CHUNK_ROWS:
            continue
        key = np.asarray(batch.column("key"))
        at = int(np.searchsorted(key, key[-1]))
        if at == 0 and (len(held) == 1 or held[-2].column("key")[-1].as_py() == int(key[0])):
            continue
        yield pa.concat_batches([*held[:-1], batch.slice(0, at)])
        held, rows = [batch.slice(at)], batch.num_rows - at
    if held:
        yield pa.concat_batches(held)


def _keyed(docs: DataFrame) -> DataFrame:
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))
    return docs.select(doc.alias("doc"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("th"), "doc_id", "text")


def hot_anchors(docs: DataFrame, span: int, seed: int, sample: int = SAMPLE, rows: int = HOT_ROWS) -> np.ndarray:
    """Hashes of anchors that many windows of a sample of the documents have, sorted. They only decide how rows are dealt out."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for whole in batches for x in _text.slices(whole, "text", *BATCH)):
            if (found := _split(_text.Words(batch.column("text"), lower=False), span, seed)) is not None:
                yield pa.RecordBatch.from_arrays([pa.array(found[5].view(np.int64)), pa.array(found[4])], names=["key", "n"])

    some = _keyed(docs).where(F.pmod(F.xxhash64("doc", "th"), F.lit(sample)) == 0).select("text")
    found = some.mapInArrow(keys, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= rows)
    return np.sort(np.array([r.key for r in found.orderBy(F.desc("n"), "key").limit(HOT_ANCHORS).collect()], np.int64).view(np.uint64))


def segments(docs: DataFrame, span: int = SPAN, seed: int = 0, sample: int = SAMPLE, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Occurrences of segments: seg (0: a copy that went in its batch), doc, th, begin (of the first window), len (windows), n (occurrences), first (of the smallest coordinates).

    ``doc`` is doc_id (null: the largest long, so that such rows yield to all others), ``th`` a hash of the text, which tells rows of one doc_id apart.
    """
    spark = docs.sparkSession
    ship(spark)
    hot = spark.sparkContext.broadcast(hot_anchors(docs, span, seed, sample, hot_rows))

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _text.slices(whole, "text", *BATCH):
                if (out := _pieces(batch, span, seed, hot.value)) is not None:
                    yield out

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches):
            if (out := _segments(batch)) is not None:
                yield out

    pieces = _keyed(docs).select("doc", "th", "text").mapInArrow(cut_up, PIECE)
    parts = 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))  # pieces take three times the room of the texts
    return pieces.repartition(parts, "key").sortWithinPartitions("key", "doc", "start", "th").mapInArrow(meet, SEGMENT)


def paths(found: DataFrame) -> DataFrame:
    """Segments that lead on to others without a branch, compacted: seg, up (the path's first segment), d (windows before the segment in the path), len.

    Two occurrences follow each other if one begins where the other ends; two segments are joined if all occurrences of both do. ``found`` is read several times.
    """
    rows = found.where("seg <> 0")
    a = rows.select("doc", "th", (F.col("begin") + F.col("len")).alias("begin"), F.col("seg").alias("up"), F.col("n").alias("m"), F.col("len").alias("d"))
    both = a.join(rows.select("doc", "th", "begin", "seg", "n", "len"), ["doc", "th", "begin"]).where("n = m")
    links = both.groupBy("up", "seg", "n", "d", "len").agg(F.count(F.lit(1)).alias("c")).where("c = n").select("seg", "up", "d", "len")
    every = active = cut(links)
    while not active.isEmpty():
        ahead = every.select(F.col("seg").alias("up"), F.col("up").alias("up2"), F.col("d").alias("d2"))
        moved = active.join(ahead, "up")
        moved = cut(moved.select("seg", F.col("up2").alias("up"), (F.col("d") + F.col("d2")).alias("d"), "len"))
        if moved.isEmpty():
            break
        every = cut(every.join(moved.select("seg"), "seg", "left_anti").unionByName(moved))
        active = moved
    return every


def spans(found: DataFrame, span: int = SPAN) -> DataFrame:
    """Occurrences of whole paths as spans of words: path (0: a copy that went in its batch), doc, th, begin, end, first."""
    linked = paths(found)
    heads = linked.groupBy(F.col("up").alias("seg")).agg(F.max(F.col("d") + F.col("len")).alias("whole"))
    rows = found.where("seg <> 0").join(linked.select("seg"), "seg", "left_anti").join(heads, "seg", "left")
    copies = found.where("seg = 0").withColumn("whole", F.col("len"))  # meet nothing
    every = rows.unionByName(copies.select(rows.columns))
    return every.select(F.col("seg").alias("path"), "doc", "th", "begin", (F.col("begin") + F.coalesce("whole", "len") + (span - 1)).alias("end"), "first")


def _apply(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts, found = batch.column("doc_id"), batch.column("text"), batch.column("spans")
        path, begin, end, first = ([] if found.null_count == len(found) else found.values.field(c).to_pylist() for c in ("path", "begin", "end", "first"))
        at, valid = found.offsets.to_pylist(), found.is_valid().to_pylist()
        out, seen, sizes = [], [], [0]
        for i in range(batch.num_rows):
            text = texts[i].as_py()
            words = text.encode().split() if text is not None else []
            n = len(words)
            if valid[i]:
                keep = bytearray(b"\1") * n
                for p, a, b, f in zip(path[at[i] : at[i + 1]], begin[at[i] : at[i + 1]], end[at[i] : at[i + 1]], first[at[i] : at[i + 1]]):
                    if not 0 <= a < b <= n:
                        raise ValueError(f"a span [{a}, {b}) doesn't lie in a text of {n} words")
                    if p:
                        seen.append((p, f, hashlib.blake2b(b" ".join(words[a:b]), digest_size=16).digest()))
                    if not f:
                        keep[a:b] = bytes(b - a)
                words = [x for x, k in zip(words, keep) if k]
            kept = b" ".join(words)
            out.append((n, n - len(words), hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None))
            sizes.append(len(seen))
        types = (pa.int64(), pa.int64(), pa.string(), pa.string())
        cols = [pa.array(c, t) for c, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types]
        p, f, d = zip(*seen) if seen else ((), (), ())
        digest = np.frombuffer(b"".join(d), "<i8").reshape(-1, 2)
        marks = pa.StructArray.from_arrays([pa.array(p, pa.int64()), pa.array(f, pa.bool_()), pa.array(digest[:, 0]), pa.array(digest[:, 1])], names=["path", "first", "a", "b"])
        yield pa.RecordBatch.from_arrays([ids, *cols, pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), marks)], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text", "seen"])


def _checked(docs: DataFrame, span: int, seed: int, with_text: bool, sample: int, hot_rows: int) -> DataFrame:
    """The result under one seed, with the digests that tell whether it holds."""
    found = table(segments(docs, span, seed, sample, hot_rows), "segments")[0]
    by_row = spans(found, span).groupBy("doc", "th").agg(F.collect_list(F.struct("path", "begin", "end", "first")).alias("spans"))
    rows = _keyed(docs).join(by_row, ["doc", "th"], "left").select("doc_id", "text", "spans")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept_text string, seen array<struct<path:long,first:boolean,a:long,b:long>>"
    return rows.mapInArrow(lambda b: _apply(b, with_text), schema)


def cut_repeats(docs: DataFrame, span: int = SPAN, with_text: bool = True, sample: int = SAMPLE, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``doc_id``, n_words, n_removed, kept_sha256 and (``with_text``) kept_text of every row once the repeated spans are cut.

    Words are runs outside ASCII white space; kept words are joined by one space. Null and empty texts have no words and the hash of
    nothing. Rows of equal doc_id and text don't make each other go. Very long texts are cut up whole, some 200 bytes of memory a word. An empty table
    gives no rows; other columns don't matter.
    """
    for seed in range(ATTEMPTS):
        out = alone(_checked)(docs, span, seed, with_text, sample, hot_rows)
        seen = out.select(F.explode("seen").alias("s")).select("s.path", "s.first", F.struct("s.a", "s.b").alias("d"))
        if seen.groupBy("path").agg(F.min("d").alias("x"), F.max("d").alias("y"), F.max("first").alias("f")).where("x <> y OR NOT f").isEmpty():
            return out.drop("seen") if with_text else out.drop("seen", "kept_text")
    raise RuntimeError("equal hashes of different windows under each of several seeds")
