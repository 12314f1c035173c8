"""Each operator against a brute-force version, on rows with nulls, empty and long texts, ties, repeats and columns of clashing names."""

import hashlib
import io
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from packloom.llm import _text, decontam, entries, graph, langid, mixing, neardup, quality, sharding, substring, tokens, urlfilter, warc
from packloom.llm._store import scratch
from packloom.llm.entries import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `row` string, h string, key string, n string, shard string, component string, gone string, leaking string, words string, block string, line string"


def make_docs():
    rnd = random.Random(5)
    vocab = {"en": ["the", "and", "of", "house", "water", "river", "green", "thing"], "fr": ["le", "la", "été", "maison", "rivière", "où", "vert", "chose"]}
    vocab = {k: v + [a + b for a in v for b in v] for k, v in vocab.items()}
    text = lambda n, lang="en": " ".join(rnd.choice(vocab[lang]) + (".\n" if rnd.random() < 0.08 else "") for _ in range(n))
    rows = []
    for i in range(60):
        lang = "en" if i % 2 else "fr"
        rows.append((i, text(rnd.randint(30, 200), lang), lang if i % 7 else None, f"src{i % 3}"))
    base = text(120)
    rows += [(100 + i, base, "en", "src0") for i in range(5)]
    for i in range(12):
        w = base.split(" ")
        for _ in range(rnd.randint(1, 6)):
            w[rnd.randrange(len(w))] = "changed" + str(rnd.randrange(99))
        rows.append((120 + i, " ".join(w), "en", "src1"))
    shared = text(40)
    rows += [(140 + i, text(60) + " " + shared + " " + text(30), "en", None) for i in range(6)]
    rows += [(150, None, "en", "src0"), (151, "", "en", "src0"), (152, " \t\n ", None, None), (153, "one two", "en", "src9"), (154, "one two", "en", "src9")]
    rows += [(155, text(30_000), "en", "src2"), (156, "*** $$$ 123", None, "src2"), (157, "a b c " * 60, "en", "src2"), (158, "boiler plate\n" * 30, "en", "src2")]
    rows += [(10, rows[10][1], rows[10][2], "src1"), (None, text(50), "en", "src1"), (None, None, None, None), (160, "Été  où là 'x' ퟿ \U0001f600 " * 9, "fr", "src2")]
    return [(i, t, lang, s, len(t or ""), *"abcdefghijk") for i, t, lang, s in rows]


@pytest.fixture(scope="module")
def rows():
    return make_docs()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text, lower=False):
    text = text or ""
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text) if lower else text)


def shingles(text):
    w = words(text, True)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def thue_morse(n):
    """Two different words of 2**n letters that collide under polynomials modulo 2**64."""
    a, b = "a", "b"
    for _ in range(n):
        a, b = a + b, b + a
    return a, b


def test_word_hashes_match_words():
    texts = ["a b", None, "", " x\ty\x0bz ", "Ab aB ab", "w" * 3_000_000 + " tail", "ab", "é è é", " ".join(thue_morse(10)), "12345678 123456789 1234567812345678 1234567812345679 x" * 3]
    w, bounds = _text.word_hashes(pa.array(texts), lower=True)
    counts = np.diff(bounds).tolist()
    assert counts == [len(words(t)) for t in texts]
    flat = [x for t in texts for x in words(t, True)]
    seen = {}
    for word, h in zip(flat, w.tolist()):
        assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_only_results_stay(spark, docs):
    """The tables that a result was made of are deleted, and in a scope of ``freed`` the result's, too."""
    import os

    from packloom.llm._store import freed, shared_dir

    here = lambda: {f for f in os.listdir(shared_dir(spark)) if "-" in f and not f.startswith("tokens")}
    before = here()
    out = substring.cut_repeats(docs.where("doc_id < 20"), with_text=False)
    assert len(here() - before) == 1 and out.count() > 0
    with freed():
        assert neardup.near_duplicates(docs.where("doc_id < 20")).count() > 0
        assert len(here() - before) == 2
    assert len(here() - before) == 1


# 1

PAGES = [(1, "http://a/1", "x" * 1200), (2, "http://a/2", "x" * 1200), (3, None, "x" * 1200), (4, "u\r\nX: y", None), (5, "é", ""), (6, "b", "small"), (7, "b", "small"), (8, "c", "é" * 70_000), (None, "n", "x" * 1200), (2, "http://a/2", "x" * 1200)]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame([(*p, "z") for p in PAGES], "page_id long, url string, html string, payload string")
    archives = warc.write_archives(warc.with_revisits(pages), scratch(spark, "t"), roll_bytes=500)
    got = warc.read_archives(archives).collect()
    assert not [r for r in got if r.kind == "gap"] and len(got) == len(PAGES)
    for r in got:
        html = next(h for p, u, h in PAGES if p == r.record_id) or ""
        raw = html.encode()
        again = len(raw) >= 1000 and r.record_id in (1, 2, None)
        assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", 3) if again else ("response", None))
        assert r.payload == (None if again else raw)
    empty = warc.write_archives(warc.with_revisits(pages.limit(0)), scratch(spark, "t"))
    assert warc.read_archives(empty).count() == 0


@pytest.mark.parametrize("gz", [True, False])
def test_warc_salvage(gz):
    parts = []
    for i in range(40):
        p = f"payload {i} ".encode() * (i * 50 + 1)
        data = warc.encode_record(i, f"http://h/{i}", p, hashlib.sha1(p).hexdigest(), None)
        if gz:
            z = zlib.compressobj(6, zlib.DEFLATED, 31)
            data = z.compress(data) + z.flush()
        parts.append(data)
    parts[3] = parts[3][: len(parts[3]) // 2]  # cut off
    parts[10] = bytes([parts[10][0] ^ 1]) + parts[10][1:]
    parts[20] = parts[20][:-12] + b"\0" * 12
    whole = b"junk WARC/9 \x1f\x8b\x08 more" + b"".join(parts[:30]) + b"\1" * 2_500_000 + b"".join(parts[30:]) + b"tail"
    name = "a.warc.gz" if gz else "a.warc"
    got = list(warc.salvage(io.BytesIO(b"WARC" * 0 + whole), name))
    found = [r["record_id"] for r in got if r["kind"] == "record"]
    assert found == [i for i in range(40) if i not in (3, 10, 20)]
    assert all(a["end"] == b["start"] for a, b in zip(got, got[1:])) and got[0]["start"] == 0 and got[-1]["end"] == len(whole)
    assert all(r["reason"] for r in got if r["kind"] == "gap")


@pytest.mark.parametrize("gz", [True, False])
def test_warc_long_url(spark, gz):
    pages = spark.createDataFrame([(1, "http://h/" + "a" * 70_000, "x"), (2, "http://h/" + "\x01" * 500_000, "y" * 3_000_000), (3, "z", "z")], "page_id long, url string, html string")
    archives = warc.write_archives(warc.with_revisits(pages.coalesce(1)), scratch(spark, "t"), gzip=gz)
    got = warc.read_archives(archives).collect()
    assert sorted((r.kind, r.record_id, len(r.target_uri), r.payload_bytes) for r in got) == [("record", 1, 70_009, 1), ("record", 2, 1_500_009, 3_000_000), ("record", 3, 1, 1)]


def foreign(kind, block, *fields, content="application/http; msgtype=response"):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", "WARC-Record-ID: <urn:uuid:0f1e2d3c-4b5a-4978-8695-a4b3c2d1e0f1>", f"Content-Type: {content}", *fields, f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@pytest.mark.parametrize("how", ["plain", "members", "one member", "broken member"])
def test_warc_foreign_archives(how):
    body = b"5\r\nhello\r\n0\r\n\r\n"
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + body
    parts = [
        foreign("warcinfo", b"software: x\r\n", content="application/warc-fields"),
        foreign("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n"),
        foreign("response", chunked, "WARC-Payload-Digest: sha1:" + hashlib.sha1(b"hello").hexdigest()),
        foreign("response", chunked, "WARC-Payload-Digest: sha256:" + hashlib.sha256(body).hexdigest(), "X-Folded: a", " b"),
        foreign("response", b"HTTP/1.1 200 OK\r\n\r\nno length", "WARC-Payload-Digest: other:xyz"),
        foreign("metadata", random.Random(1).randbytes(300_000), content="text/plain"),
        foreign("response", b"20240101\nexample.org. 1 IN A 192.0.2.1", content="text/dns"),
    ]
    z = lambda x: (c := zlib.compressobj(6, zlib.DEFLATED, 31)).compress(x) + c.flush()
    data = {"plain": b"".join(parts), "members": b"".join(map(z, parts)), "one member": z(b"".join(parts)), "broken member": z(b"".join(parts))[:-8] + z(parts[0])}[how]
    got = list(warc.salvage(io.BytesIO(data), "f.warc" if how == "plain" else "f.warc.gz"))
    kinds = ["warcinfo", "request", "response", "response", "response", "metadata", "response"]
    if how == "broken member":
        assert [r.get("record_type") for r in got] == [*kinds[:-1], None, "warcinfo"] and got[-2]["kind"] == "gap"
    else:
        assert [r.get("record_type") for r in got] == kinds and {r["record_id"] for r in got} == {None}
        assert [r["payload_bytes"] for r in got] == [13, 0, 15, 15, 9, 300_000, 38]
    assert got[0]["start"] == 0 and got[-1]["end"] == len(data) and all(a["end"] == b["start"] for a, b in zip(got, got[1:]))
    bad = foreign("response", chunked, "WARC-Payload-Digest: sha256:" + "0" * 64)
    assert [r["kind"] for r in warc.salvage(io.BytesIO(bad), "b.warc")] == ["gap"]


def test_warc_query_fails_on_lost_records(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, "u", "x"), (2, "v", "y")], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert entries.op1_warc_salvage(spark, str(tmp_path)).count() == 2
    read = warc.read_archives
    monkeypatch.setattr(warc, "read_archives", lambda *a, **b: read(*a, **b).where("record_id <> 2"))
    with pytest.raises(RuntimeError, match="2 records were written, 1 were read back"):
        entries.op1_warc_salvage(spark, str(tmp_path))


# 2


def brute_capacity(sizes, shards):
    def need(c):
        n, room = 0, 0
        for s in sizes:
            if s > room:
                n, room = n + 1, max(c, s)
            room = room - s if s <= c else 0
        return n

    lo, hi = 0, sum(sizes)
    while lo + 1 < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if need(mid) <= shards else (mid, hi)
    return hi


def best_least(sizes, capacity, shards):
    """The largest smallest shard of all partitions that keep the capacity."""
    ends = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    best = {0: sum(sizes)}
    for _ in range(shards):
        now = {}
        for j, e in enumerate(ends):
            found = [min(v, e - ends[i]) for i, v in best.items() if i < j and e - ends[i] <= capacity]
            if found:
                now[j] = max(found)
        best = now
    return best[len(sizes)]


def test_minimax_cuts_against_brute_force(spark):
    rnd = random.Random(3)
    for n, shards, bins, split, huge in [(50, 4, 8, 2, 0), (300, 7, 16, 4, 5000), (5, 9, 4, 2, 0), (400, 40, 4096, 64, 90_000)]:
        sizes = [rnd.randint(16, 400) for _ in range(n)]
        if huge:
            sizes[n // 3] = huge
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).tolist()
        got, cuts = sharding.minimax_cuts(spark.createDataFrame([(s,) for s in starts], "start long"), sum(sizes), shards, bins, split)
        assert got == brute_capacity(sizes, shards)
        assert len(cuts) <= shards and set(cuts) <= set(starts)
        measure = lambda cuts: [sum(sizes[i] for i, s in enumerate(starts) if a <= s < b) for a, b in zip(cuts, [*cuts[1:], sum(sizes)])]
        spans = measure(cuts)
        assert max(spans) <= max(got, max(sizes)) and all(s <= got or s in sizes for s in spans)
        level = sharding.level_cuts(spark.createDataFrame([(s,) for s in starts], "start long"), sum(sizes), got, cuts, shards)
        even = measure(level)
        assert level[0] == 0 and set(level) <= set(starts) and all(s <= got or s in sizes for s in even) and len(level) <= shards
        assert min([*even, *[0] * (shards - len(even))]) >= min([*spans, *[0] * (shards - len(spans))])
        if n <= 50 and len(even) == shards:  # the best of all choices
            assert min(even) == best_least(sizes, got, shards)


def test_shard_documents(docs, no_docs, rows):
    got = sharding.shard_documents(docs).collect()
    assert len(got) == len(rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and sorted(slots) == list(range(40))
    # shards in order, filled by whole groups in order of their smallest doc_id
    group = lambda t: ("n", "") if t is None else ("t", t)
    first = {}
    for i, t, *_ in rows:
        if i is not None:
            first[group(t)] = min(first.get(group(t), i), i)
    laid = sorted(got, key=lambda r: (r.shard, r.slot))
    of = {(len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), i): first.get(group(t), -1) for i, t, *_ in rows}
    place = [of[r.size, r.text_crc32, r.doc_id] for r in laid]
    assert place == sorted(place)
    homes, total = defaultdict(set), defaultdict(int)
    for r in got:
        total[r.shard] += r.size
        if r.text_crc32:
            homes[r.text_crc32, r.size].add(r.shard)
    assert all(len(v) == 1 for v in homes.values())
    size = Counter()
    for _, t, *_ in rows:
        size[group(t)] += len((t or "").encode()) + 16
    capacity = brute_capacity([size[g] for g in sorted(size, key=lambda g: first.get(g, -1))], 40)
    assert all(v <= capacity or v in size.values() for v in total.values())
    assert sharding.shard_documents(no_docs).count() == 0


# 3


def brute_quality(rows):
    lines = []
    host_docs, line_docs = defaultdict(set), defaultdict(set)
    for i, r in enumerate(rows):
        norm = [" ".join(words(x.lower())) for x in (r[1] or "").split("\n") if words(x)]
        lines.append(norm)
        doc = ("row", i) if r[0] is None else r[0]
        host_docs[r[3]].add(doc)
        for x in norm:
            line_docs[r[3], x].add(doc)
    hosts, seen = ({k: len(v) for k, v in x.items()} for x in (host_docs, line_docs))
    out = []
    for r, norm in zip(rows, lines):
        w = words(r[1])
        where = defaultdict(list)
        for i in range(len(w) - 2):
            where[tuple(w[i : i + 3])].append(i)
        repeat = {j for v in where.values() if len(v) > 1 for i in v for j in (i, i + 1, i + 2)}
        raw = [x for x in (r[1] or "").split("\n") if words(x)]
        failed = len(w) < 50 or 100 * len(repeat) > 50 * len(w)
        total = sum(map(len, norm))
        left = sum(len(x) for x in norm if not (seen[r[3], x] > 10 and 100 * seen[r[3], x] > hosts[r[3]]))
        out.append((r[0], len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in r[1] or ""), len(raw) - len(set(raw)), len(repeat), failed, not failed and 100 * left >= 30 * total))
    return Counter(out)


def test_quality(spark, docs, no_docs, rows):
    more = [(1000 + i, f"unique {i} " + "word" * (i + 1) + "\nCommon   Line here\n" + " ".join(f"w{i}{j}" for j in range(60 if i % 2 else 1)) + "\ncommon line HERE" * (50 if i % 3 == 0 else 1), "en", "hot", 0, *"abcdefghijk") for i in range(40)]
    both = docs.union(spark.createDataFrame(more, SCHEMA))
    assert Counter(tuple(r) for r in quality.judge_quality(both).collect()) == brute_quality(rows + more)
    assert quality.judge_quality(no_docs).count() == 0
    cleaned = {r.doc_id: r.text for r in quality.cleaned_documents(both).collect()}
    assert "ommon" not in cleaned[1001] and cleaned[1001].startswith("unique 1") and cleaned[150] is None and cleaned[151] == ""


def test_quality_counts_documents_not_rows(spark):
    """Rows of one doc_id, in one host and in two, and rows of null doc_ids, against brute force and the SQL."""
    import duckdb

    long = lambda name: " ".join(f"{name}document{j}" for j in range(120))
    said = lambda i, line: f"own {i} line\n{line}\n" + " ".join(f"w{i}x{j}" for j in range(60))
    rows = [(7, said(7, "same line of one document"), "en", "a") for _ in range(12)] + [(7, said(7, "same line of one document"), "en", "b")] * 12
    rows += [(i, said(i, long("eleven")), "en", "a") for i in range(20, 31)] + [(i, said(i, long("ten")), "en", "a") for i in range(40, 50)] * 2
    rows += [(None, said(i, long("unnamed")), "en", "a") for i in range(11)] + [(i, f"plain {i}\n" * 3, "en", "b") for i in range(60, 90)] + [(91, None, None, None)]
    rows = [(*r, 0, *"abcdefghijk") for r in rows]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = Counter(tuple(r) for r in quality.judge_quality(frame.repartition(5)).collect())
    assert got == brute_quality(rows)
    kept = {k[0]: k[-1] for k in got}
    assert kept[7] and kept[40] and not kept[20] and not kept[None]
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": [r[1] for r in rows], "source": [r[3] for r in rows]}))
    assert Counter(con.execute(entries.OP3_SQL).fetchall()) == got


# 4


def test_language_identification(spark, docs, no_docs, rows):
    got = langid.identify(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    pred = {r.doc_id: r.lang_pred for r in got}
    assert all(pred[i] == ("en" if i % 2 else "fr") for i in range(60))
    assert all(pred[i] == "und" for i in (150, 151, 152, 156))
    assert langid.identify(no_docs).count() == 0
    kept = langid.identified(docs, 0.3)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.lang_pred != "und"}
    nothing = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert langid.identify(nothing).first().lang_pred == "und"


def test_texts_of_no_learned_language(spark, rows):
    """They get a learned language like any other text with a letter; only the filter rejects them."""
    odd = [(901, "Η γρήγορη καφέ αλεπού πηδάει πάνω από το τεμπέλικο σκυλί " * 4), (902, "xkcd qwrtp zzgh bvnm plkj hgfd " * 9), (903, "1 2 3")]
    docs = spark.createDataFrame(rows + [(i, t, None, None, len(t), *"abcdefghijk") for i, t in odd], SCHEMA)
    got = {r.doc_id: r for r in langid.identify(docs).where("doc_id > 900 OR doc_id = 7").collect()}
    assert got[901].lang_pred in ("en", "fr") and got[902].lang_pred in ("en", "fr") and not got[901].known and not got[902].known
    assert got[903].lang_pred == "und" and got[903].score == 0 and got[7].known
    assert {r.doc_id for r in langid.identified(docs, 0.2).where("doc_id > 900 OR doc_id = 7").collect()} == {7}


def test_kernel_is_the_presence_kernel():
    texts = ["La maison, verte!", "la  Maison", "xyz", "é"]
    letters = "".join(sorted({c for t in texts for c in t.lower() if c.isalpha()}))
    table = langid.letter_table(letters)

    m = langid.fit([(t, str(i)) for i, t in enumerate(texts)])
    k = m.kernels(texts, table)
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            x, y = grams(a), grams(b)
            assert abs(k[i, j] - len(x & y) / (len(x) * len(y)) ** 0.5) < 1e-5


def grams(text, n=3):
    """The distinct sequences of 1 to n signs of a text and the line end behind it."""
    signs = re.sub(r"\x00+", "\x00", "".join(c if c.isalpha() else "\x00" for c in text.lower() + "\n"))
    return {signs[i : i + k] for k in range(1, n + 1) for i in range(len(signs) - k + 1)}


def test_scores_are_those_of_a_dense_solve(rows):
    """Kernel ridge regression solved over all rows with the kernel that Nyström landmarks give, in plain double precision."""
    labelled = [(r[1], r[2]) for r in rows if r[2] and any(map(str.isalpha, r[1] or "")) and len(r[1]) < 20_000]
    model = langid.fit(labelled)
    spectra = [grams(t) for t, _ in labelled]
    k = lambda a, b: len(a & b) / (len(a) * len(b)) ** 0.5
    marks = [x for lang in model.langs for x in [x for x, (_, y) in zip(spectra, labelled) if y == lang][: langid.LANDMARKS]]
    between = np.array([[k(a, b) for b in marks] for a in marks])
    value, vector = np.linalg.eigh(between)
    good = value > 1e-6 * value.max()
    inverse = (vector[:, good] / value[good]) @ vector[:, good].T
    cross = np.array([[k(a, b) for b in marks] for a in spectra])
    gram = cross @ inverse @ cross.T
    center = np.eye(len(gram)) - 1 / len(gram)
    y = np.array([[1.0 if lang == x else -1.0 for x in model.langs] for _, lang in labelled])
    dual = np.linalg.solve(center @ gram @ center + langid.RIDGE * np.eye(len(gram)), y - y.mean(0))
    fresh = [r[1] for r in rows if not r[2] and r[1] and any(map(str.isalpha, r[1]))] + ["la maison verte", "the green house " * 30]
    new = np.array([[k(grams(t), b) for b in marks] for t in fresh]) @ inverse @ cross.T
    want = (new - gram.mean(0)) @ center @ dual + y.mean(0)
    got, _ = model.score(fresh, langid.letter_table(model.letters))
    assert np.abs(got - want).max() < 1e-2 and (got.argmax(1) == want.argmax(1)).all()


def test_spectra_of_long_texts_and_many_letters(monkeypatch):
    letters = "".join(map(chr, [*range(0x61, 0x7B), *range(0x4E00, 0x9000), *range(0xAC00, 0xD7A4)]))
    table = langid.letter_table(letters)
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(letters[:40] + "   ..") for _ in range(900)), "", "漢字かな 한글 漢", "abc" * 50]
    want = []
    for i, t in enumerate(texts):
        signs = re.sub(r"\x00+", "\x00", "".join(c if c.isalpha() else "\x00" for c in t + "\n"))
        place = {c: letters.index(c) + 1 if c in letters else 0 if c == "\x00" else len(letters) + 1 for c in set(signs)}
        base = len(letters) + 2
        want += [(i, v) for v in sorted({n * base**3 + sum(place[c] * base ** (n - 1 - j) for j, c in enumerate(signs[a : a + n])) for n in (1, 2, 3) for a in range(len(signs) - n + 1)})]
    for slab in (1 << 18, 100):
        monkeypatch.setattr(langid, "SLAB_CHARS", slab)
        code, row = langid.spectra(texts, table, len(letters) + 2)
        assert list(zip(row.tolist(), code.tolist())) == want


# 5


def spark_hash(*values):
    """Spark's xxhash64 of longs, ints, strings and nulls."""
    h = 42
    for v, kind in values:
        if v is not None:
            h = xxhash.xxh64_intdigest(v.encode() if kind == "s" else struct.pack("<" + kind, v), h)
    return h - 2**64 if h >= 2**63 else h


def brute_permuted(x, n, key, rounds=24):
    for i in range(rounds):
        other = (spark_hash((key, "q"), (i, "i")) % n - x) % n
        if spark_hash((key, "q"), (i, "i"), (max(x, other), "q"), (1, "i")) & 1:
            x = other
    return x


def brute_mix(rows):
    """Of each row (doc_id, size, source_size, target, taken, first_shard), by plain loops."""
    rows = [(r[0], r[1], r[3], len(words(r[1]))) for r in rows]
    names = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    goal = mixing.targets([sum(r[3] for r in rows if r[2] == s) for s in names])
    out, plan = [], []
    for src, (name, target) in enumerate(zip(names, goal)):
        mine = [r for r in rows if r[2] == name]
        order = lambda r: spark_hash((r[0], "q"), (mixing.SEED, "i"), (spark_hash((r[1], "s")), "q"))
        parts = max(1, -(-len(mine) // mixing.BUCKET_ROWS))
        mine.sort(key=lambda r: (order(r) % parts, order(r), r[0] is not None, r[0] or 0, r[3]))
        size = sum(r[3] for r in mine)
        words_ = max(1, min(mixing.BLOCK_WORDS, size // mixing.BLOCK_WORDS))
        blocks = -(-size // words_)
        quota = int(target * blocks / size + 0.5) if size else 0
        plan.append((src, mine, size, target, blocks, quota, words_))
    slots, base = sum(p[5] for p in plan), 0
    for src, mine, size, target, blocks, quota, words_ in plan:
        drawn, shard = Counter(), {}
        for j in range(quota):
            place = brute_permuted(base + j, slots, spark_hash((mixing.SEED, "i"), ("shards", "s")))
            block = brute_permuted(j % blocks, blocks, spark_hash((mixing.SEED, "i"), (src, "q"), (j // blocks, "q")))
            drawn[block] += 1
            shard[block] = min(shard.get(block, 2**62), place // mixing.SHARD_SLOTS)
        base += quota
        at = 0
        for doc_id, _, _, n in mine:
            at, spans_ = at + n, [(at + i) // words_ for i in range(n)]
            first = min((shard[b] for b in set(spans_) if b in shard), default=None)
            out.append((doc_id, n, size, target, sum(drawn[b] for b in spans_), first))
    return Counter(out)


def test_mixing(spark, docs, no_docs, rows, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 100)
    monkeypatch.setattr(mixing, "RANGE_SLOTS", 64)
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 10)
    monkeypatch.setattr(mixing.slots_of, "__defaults__", (mixing.SEED, 100))
    got = mixing.mix_shares(docs).collect()
    assert Counter(tuple(r) for r in got) == brute_mix(rows)
    assert len({r.first_shard for r in got}) > 2
    assert Counter((r.doc_id, r.size, r.taken) for r in got) == Counter((r.doc_id, r.size, r.taken) for r in mixing.mix_shares(docs.repartition(3)).collect())
    by = defaultdict(lambda: [0, 0])
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        by[r.source_size, r.target][0] += r.taken
        by[r.source_size, r.target][1] += r.size
    for (size, target), (taken, own) in by.items():
        assert size == own and abs(taken - target) <= 2 * mixing.BLOCK_WORDS
    blocks = mixing.mixed_blocks(docs).collect()
    slots = {(r.shard, r.slot) for r in blocks}
    assert sorted(slots) == [(i // 100, i % 100) for i in range(len(slots))]
    assert mixing.mix_shares(no_docs).count() == 0
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    taken = sorted((r.doc_id or -1, r.taken) for r in got if r.taken)
    assert sorted((r.doc_id or -1, len(words(r.text))) for r in out.collect()) == taken
    assert mixing.mixed_documents(no_docs).count() == 0


def test_small_sources_meet_their_targets(spark):
    sizes = [1, 2, 3, 5, 65, 65, 65, 65, 100, 300, 7, 0]
    rows = [(i, " ".join(f"w{j}" for j in range(n)), None, f"s{i:02}" if i else None, n, *"abcdefghijk") for i, n in enumerate(sizes)]
    got = mixing.mix_shares(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(abs(r.taken - r.target) <= 4 and r.taken <= 3 * r.size for r in got) and sum(r.taken > 0 for r in got) > 8


def test_targets():
    assert mixing.targets([100, 100, 100]) == [187.5, 75.0, 37.5]
    assert mixing.targets([10, 100, 100]) == [30.0, 120.0, 60.0]
    assert mixing.targets([0, 0]) == [0.0, 0.0] and mixing.targets([]) == []


def test_permutation(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 7, 100):
        rows = spark.createDataFrame([(i,) for i in range(n)], "id long")
        got = {r.id: r.p for r in mixing.permuted(rows, "p", F.col("id"), F.lit(n), F.lit(5).cast("long"), 2).collect()}
        assert sorted(got.values()) == list(range(n)) and (n < 100 or got != {i: i for i in range(n)})
        assert got == {i: brute_permuted(i, n, 5) for i in range(n)}


def test_mix_of_many_sources(spark):
    """Levels are raised until no target is above its bound."""
    rows = [(i, "w " * (i % 9 + (300 if i % 50 == 0 else 0)), f"s{i % 60}" if i % 61 else None) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert Counter(tuple(r) for r in mixing.mix_shares(docs).collect()) == brute_mix([(i, t, None, s) for i, t, s in rows])


# 6


def test_leaks(spark, docs, no_docs, rows):
    w = words(rows[5][1])
    items = [(1, " ".join(w[3:25])), (2, " ".join([*w[3:20], "zz", "yy"])), (3, "nothing of this is anywhere in them"), (4, None), (5, ""), (6, "One  TWO"), (7, " ".join(words(rows[-5][1])[:3])), (None, " ".join(w[:12])), (1, " ".join(w[3:25]))]
    table = spark.createDataFrame(items, "item_id long, text string")
    expected = Counter()
    for d in rows:
        s = shingles(d[1])
        for i, t in items:
            x = shingles(t)
            if x and 100 * len(x & s) >= 75 * len(x):
                expected[d[0], i, len(x), len(x & s)] += 1
    assert expected[5, 1, 18, 18] == 2
    for size in (16 << 20, 100):
        assert Counter(tuple(r)[:4] for r in decontam.leak_pairs(docs, table, block_bytes=size).collect()) == expected
    kept = decontam.without_leaks(docs, table)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - {k[0] for k in expected}
    assert decontam.leak_pairs(no_docs, table).count() == 0 and decontam.leak_pairs(docs, table.limit(0)).count() == 0


def test_leaks_compare_words(monkeypatch, spark):
    """Words and shingles that share a hash are told apart."""
    real = _text.span_hashes
    words_of = [f"w{i}" for i in range(40)]
    items = [" ".join(words_of[:12]), " ".join(words_of[20:40]), "w1 w2"]
    texts = [" ".join(words_of[1:12]), " ".join(words_of[5:30]), " ".join(["zz", *words_of[20:38]]), "w1 w2", "w2 w1", None]
    for bits in (64, 2):
        monkeypatch.setattr(_text, "span_hashes", lambda *a, m=np.uint64(2**bits - 1): real(*a) & m)
        index = decontam.Index(list(range(3)), items, 5, 75)
        assert index.need.tolist() == [6, 12, 1] and index.n.tolist() == [8, 16, 1] and len(index.parts) == 3
        got = {(r, i): n for r, i, n in index.leaks(decontam.Windows(pa.array(texts), 5))}
        sets = [shingles(t) for t in texts]
        assert got == {(r, i): len(shingles(items[i]) & s) for i in range(3) for r, s in enumerate(sets) if len(shingles(items[i]) & s) >= index.need[i]}
    monkeypatch.undo()
    left, right = thue_morse(10)
    docs = spark.createDataFrame([(1, f"a {left} c d e f"), (2, f"a {right} c d e f")], "doc_id long, text string")
    table = spark.createDataFrame([(1, f"A {left} c d e f")], "item_id long, text string")
    assert [tuple(r) for r in decontam.leak_pairs(docs, table).collect()] == [(1, 1, 2, 2, 1.0)]


# 7


def test_similar_compares_words(monkeypatch, spark):
    real, rnd = _text.span_hashes, random.Random(6)
    texts = [" ".join(rnd.choice("abcdefgh") + rnd.choice("xy") for _ in range(rnd.randint(0, 40))) for _ in range(30)]
    u = [rnd.choice(texts) for _ in range(60)] + [None, "A b"]
    v = [rnd.choice(texts) if i % 2 else t + " tail" for i, t in enumerate(u[:60])] + ["x", "a B"]
    want = []
    for a, b in zip(u, v):
        x, y = shingles(a), shingles(b)
        want.append(bool(x & y) and 100 * len(x & y) >= 75 * len(x | y))
    assert any(want) and not all(want)
    for bits in (64, 2):
        monkeypatch.setattr(_text, "span_hashes", lambda *a, m=np.uint64(2**bits - 1): real(*a) & m)
        assert neardup.similar(pa.array(u), pa.array(v)) == want
    monkeypatch.undo()
    left, right = thue_morse(10)
    docs = spark.createDataFrame([(1, left), (2, right), (3, left.upper())], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(docs).collect()} == {1: 1, 2: 2, 3: 1}


def test_large_mixed_buckets_are_compared_in_blocks(monkeypatch, spark):
    """Classes of several components in one bucket, in more than one block: each pair across components once, none twice."""
    rnd = np.random.default_rng(5)
    n = 40
    sketch = rnd.integers(0, 256, neardup.M + neardup.PARITY // 8).astype(np.uint8).tobytes()
    known = spark.createDataFrame([(i, 50, bytearray(sketch)) for i in range(n)], "id long, n_shingles long, sketch binary")
    members = spark.createDataFrame([(k, i) for i in range(n) for k in (7, 8)], "key long, id long")
    comp = spark.createDataFrame([(i, 0) for i in range(1, 25)] + [(i, 30) for i in range(31, 34)], "id long, component long")
    of = {i: 0 if i < 25 else 30 if 30 <= i < 34 else i for i in range(n)}
    monkeypatch.setattr(neardup, "BLOCK", 6)
    monkeypatch.setattr(neardup, "cut", lambda df: df)
    got = [tuple(r) for r in neardup._candidates(members, known, comp, 0).collect()]
    assert Counter(got) == Counter((a, b) for a in range(n) for b in range(a + 1, n) if of[a] != of[b])


def test_near_duplicates(docs, no_docs, rows):
    sets = [(r[0], shingles(r[1])) for r in rows]
    root = {i: i for i, _ in sets if i is not None}
    links = [(a, b) for a, x in sets for b, y in sets if a is not None and b is not None and a < b and x and 100 * len(x & y) >= 75 * len(x | y)]
    while any(root[a] != root[b] for a, b in links):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = neardup.near_duplicates(docs)
    assert Counter(tuple(r) for r in got.collect()) == Counter((i, len(s), root.get(i), root.get(i) == i) for i, s in sets)
    assert neardup.near_duplicates(no_docs).count() == 0
    kept = neardup.without_duplicates(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in sets if i is None or root[i] == i}


def test_super_minhash():
    rnd = np.random.default_rng(1)

    def plain(elements, m):
        """One element at a time, as published, with the operator's random numbers."""
        h = np.full(m, ~np.uint64(0))
        for e in elements:
            p = list(range(m))
            for j in range(m):
                x = int(_text.mix(np.array([e], np.uint64) + np.array([((j + 1) * 0x9E3779B97F4A7C15) % 2**64], np.uint64))[0])
                k = j + ((x & 0xFFFFFFFF) * (m - j) >> 32)
                p[j], p[k] = p[k], p[j]
                h[p[j]] = min(int(h[p[j]]), j << 32 | x >> 32)
        return h

    sets = [rnd.integers(0, 2**63, n).astype(np.uint64) for n in (1, 3, 40, 300)]
    sig = neardup.super_minhash(np.concatenate(sets), np.repeat(np.arange(4), [len(s) for s in sets]), 4, 16)
    for s, row in zip(sets, sig):
        assert (plain(s, 16) == row).all()
    a = rnd.integers(0, 2**63, 400).astype(np.uint64)
    both = neardup.super_minhash(np.concatenate([a[:300], a[100:]]), np.repeat([0, 1], [300, 300]), 2, 256)
    assert abs((both[0] == both[1]).mean() - 0.5) < 0.12


def test_slices_are_bounded():
    texts = ["a" * n for n in (5, 0, 30, 3, 3, 3, 100, 1)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(texts)], names=["i", "text"])
    got = [x.column("i").to_pylist() for x in _text.slices(batch.slice(1), "text", 3, 10)]
    assert got == [[1], [2], [3, 4, 5], [6], [7, 8]]


def test_signatures_in_parts(monkeypatch):
    rnd = np.random.default_rng(2)
    elements, owner = rnd.integers(0, 2**63, 5000).astype(np.uint64), np.sort(rnd.integers(0, 7, 5000))
    whole = neardup.super_minhash(elements, owner, 7)
    monkeypatch.setattr(neardup, "WALKERS", 300)
    assert (neardup.super_minhash(elements, owner, 7) == whole).all()


def test_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(50)]
    root = {x: x for e in edges for x in e}
    while any(root[a] != root[b] for a, b in edges):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(edges, "u long, v long").repartition(7)).collect()}
    assert got == {k: v for k, v in root.items() if k != v}


# 8


def test_rans_round_trip_and_checkpoints():
    rnd = np.random.default_rng(3)
    for n, k in ((1, 1), (31, 3), (5000, 700), (200_000, 40_000)):
        s = np.minimum(rnd.zipf(1.2, n) - 1, k - 1).astype(np.int64)
        _, s, counts = np.unique(s, return_inverse=True, return_counts=True)
        f = tokens.frequencies(counts)
        assert int(f.sum()) == 1 << tokens.BITS and f.min() > 0
        lanes, x, words_, marks = tokens.encode_block(s, f, 8192)
        assert (tokens.decode_block(n, lanes, x, words_, f) == s).all()
        for step, at, states in marks:
            assert (tokens.decode_block(n, lanes, states, words_, f, step, at) == s[step * lanes :]).all()
    data = tokens.encode_segment(np.array([5, 0], np.uint32), [None], np.array([2]))
    with pytest.raises(ValueError):
        list(tokens.read_segments(io.BytesIO(tokens.MAGIC + data[:-254] + bytes([data[-254] ^ 3]) + data[-253:])))


def test_token_rows(spark, docs, no_docs, rows):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    got = tokens.token_rows(docs, scratch(spark, "t"), tokenizer_path()).collect()
    start, expected = 0, []
    h = lambda t: 42 if t is None else np.uint64(xxhash.xxh64_intdigest(t.encode(), 42)).astype(np.int64)
    for i, t, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, h(r[1]))):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert Counter(tuple(r) for r in got) == Counter(expected)
    assert tokens.token_rows(no_docs, scratch(spark, "t"), tokenizer_path()).count() == 0


def encoded(own, texts):
    ids, n = own.encode(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(ids, np.cumsum(n))[:-1]]


def test_encoder_cuts_where_the_tokenizer_does():
    from tokenizers import Tokenizer

    tok, own = Tokenizer.from_file(tokenizer_path()), tokens.Encoder(tokenizer_path())
    rnd = random.Random(4)
    signs = [*" " * 8, "\n", "\n", "\t", "\u2003", "\x1c", "\x85", "a", "b", "Z", "é", "ß", "ſ", "Ŀ", "ƀ", "×", "÷", "µ", "1", "2", "²", "٣", "'", "'s", "!", ",", "-", "漢", "<|endoftext|>", "<|", "\u200b", "\x00", "\U0001f600", "ing", "the"]
    for _ in range(60):
        texts = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 12))) for _ in range(100)] + [None, "", "w" * 100_000, *thue_morse(10)]
        assert encoded(own, texts) == [[*tok.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]
    assert own.encode(pa.array([], pa.string()))[0].tolist() == []


def test_encoder_compares_bytes(monkeypatch):
    """Pieces that share a hash are told apart."""
    from tokenizers import Tokenizer

    tok, own, real = Tokenizer.from_file(tokenizer_path()), tokens.Encoder(tokenizer_path()), _text.span_hashes
    monkeypatch.setattr(_text, "span_hashes", lambda *a: real(*a) & np.uint64(7))
    texts = [r[1] for r in make_docs()[:30]] + ["one two", "one two\nthree"]
    for _ in range(2):
        assert encoded(own, texts) == [[*tok.encode(t, add_special_tokens=False).ids, 0] for t in texts]


# 9


def brute_spans(rows, span=20):
    first, out = {}, []
    big = 2**63 - 1
    for i, t, *_ in rows:
        w = words(t)
        for a in range(len(w) - span + 1):
            k = tuple(w[a : a + span])
            first[k] = min(first.get(k, (big, big)), (big if i is None else i, a))
    for i, t, *_ in rows:
        w = words(t)
        gone = set()
        for a in range(len(w) - span + 1):
            if first[tuple(w[a : a + span])] < (big if i is None else i, a):
                gone.update(range(a, a + span))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return Counter(out)


@pytest.mark.parametrize("how", [{}, {"sample": 1, "hot_rows": 5}])
def test_substring_dedup(docs, no_docs, rows, how):
    assert Counter(tuple(r) for r in substring.cut_repeats(docs, **how).collect()) == brute_spans(rows)
    assert substring.cut_repeats(no_docs, **how).count() == 0


def test_substring_dedup_of_branching_paths(spark):
    """Passages that begin, end, branch and meet within each other, periodic texts, and words that collide under polynomials."""
    rnd = random.Random(8)
    line = [f"w{i}" for i in range(120)]
    left, right = thue_morse(10)
    texts = [" ".join(line), " ".join(line[:50] + ["x"] * 25 + line[70:]), " ".join(line[10:60]), " ".join(line[40:90] + line[:45]), "a b c " * 30, "x " * 50, " ".join(line[:20] + [left] + line[30:49]), " ".join(line[:20] + [right] + line[30:49])]
    for _ in range(25):
        texts.append(" ".join(x for _ in range(rnd.randint(1, 4)) for x in (lambda a: line[a : a + rnd.randint(5, 60)])(rnd.randrange(100))))
    rows = [(i % 28, t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert Counter(tuple(r) for r in substring.cut_repeats(docs).collect()) == brute_spans(rows)


def test_paths_without_branches_are_compacted(spark, monkeypatch):
    """A passage in several documents is one path, cut where another document leaves it or where one ends in it."""
    monkeypatch.setattr(substring, "BATCH", (1, 1 << 20))
    passage = [f"p{i}" for i in range(100)]
    rows = [(i, " ".join([f"a{i}", *passage, f"b{i}"])) for i in range(4)]
    rows += [(10 + i, " ".join(passage[50:] + [f"c{i}"] * 3)) for i in range(2)]  # begin within it
    rows += [(20 + i, " ".join([f"q{j}" for j in range(30)] + [str(i)])) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = substring.segments(docs).cache()
    got = Counter((s.doc, s.begin, s.end, s.first) for s in substring.spans(found).collect())
    want = Counter((i, 1, 70, i == 0) for i in range(4)) + Counter((i, 51, 101, i == 0) for i in range(4))
    want += Counter((10 + i, 0, 50, False) for i in range(2)) + Counter((20 + i, 0, 30, i == 0) for i in range(2))
    assert got == want and found.count() > sum(want.values())
    assert Counter(tuple(r) for r in substring.cut_repeats(docs).collect()) == brute_spans(rows)


def test_substring_dedup_tries_other_hashes(monkeypatch, spark):
    """Windows of one hash are found out by their words, and compared again under another seed."""
    tried = []
    real = substring.segments
    words_of = [f"w{i}" for i in range(30)]
    docs = spark.createDataFrame([(1, " ".join(words_of)), (2, " ".join(words_of[:15] + ["zz"] * 15)), (3, " ".join(words_of))], "doc_id long, text string")

    def wrong(docs, span, seed, *a):
        tried.append(seed)
        out = real(docs, span, seed, *a)
        if seed == 0:  # as if the second text had windows of the first
            out = out.where("seg <> 0").unionByName(spark.createDataFrame([(5, 1, 0, 0, 3, 2, True), (5, 2, 0, 0, 3, 2, False)], substring.SEGMENT).drop("th").join(docs.selectExpr("doc_id AS doc", "xxhash64(text) AS th"), "doc").select(*out.columns))
        return out

    monkeypatch.setattr(substring, "segments", wrong)
    got = {r.doc_id: r.n_removed for r in substring.cut_repeats(docs).collect()}
    assert got == {1: 0, 2: 0, 3: 30} and tried == [0, 1]


# 10


def test_url_rules_and_cascade(spark):
    urls = ["http://A.com/x", "https://example.com/en/1?q#f", "https://www.example.com/en/", "http://a.www.Example.com/en/x", "http://badexample.com/en/", "http://x.net/es/1", "http://x.net/fr", "ftp://net/fr/", "nourl", None, "", "http://", "http://host.org", "HTTPS://host2.org?x=/en/", "http://host2.org/a", "http://b.com", "http://host.org"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: r for r in urlfilter.judge_urls(pages).collect()}
    rule = {i: r.rule for i, r in got.items()}
    assert rule == {0: "com/", 1: "example.com/en/", 2: "www.example.com/en/", 3: "www.example.com/en/", 4: "com/", 5: "net/es/", 6: None, 7: "net/fr/", **{i: None for i in range(8, 17)}}
    verdict = {i: r.verdict for i, r in got.items()}
    assert [verdict[i] for i in (0, 1, 2, 5, 6, 8, 9, 12, 13, 14, 15, 16)] == ["allow", "block", "allow", "block", "block", "allow", "allow", "block", "allow", "allow", "block", "block"]
    long = spark.createDataFrame([(1, "http://a.com/en/" + "x" * 3_000_000), (2, "http://" + "h" * 100_000 + ".net/es/"), (3, None)], "page_id long, url string")
    got_long = {r.page_id: r for r in urlfilter.judge_urls(long).collect()}
    assert (got_long[1].rule, len(got_long[1].path), got_long[2].rule, got_long[2].verdict, got_long[3].verdict) == ("com/", 3_000_004, "net/es/", "block", "allow")
    assert (got[1].host, got[1].path, got[13].path, got[15].path, got[9].host) == ("example.com", "/en/1", "", "", "")
    assert urlfilter.judge_urls(pages.limit(0)).count() == 0


def test_cascade_is_exact(spark):
    from pyspark.sql import functions as F

    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 17 == 0).alias("listed"), "id")
    shards = urlfilter.cascade_shards(keys.select("key", "listed"), keys_a_shard=3000)
    assert shards.count() == 7
    for size in (64 << 20, 600):
        out = urlfilter.listed_by_cascade(keys.select("id", "key"), "key", shards, "hit", size)
        assert {r.id for r in out.where("hit").collect()} == set(range(0, 20_000, 17))
