"""Suffix-array dedup against brute force: nulls, empty and long texts, repeated rows, ties of doc_id, runs of one byte, parts that overlap, columns of clashing names."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from packloom.llm import entries, suffixes

SCHEMA = "doc_id long, text string, id string, th string, doc string, `begin` string, spans string, bucket string"


def make_rows():
    rnd = random.Random(4)
    vocab = ["house", "river", "été", "maison", "x", "over", "the", "\x00", "ÿ"]
    text = lambda n: " ".join(rnd.choice(vocab) + str(rnd.randrange(9)) * rnd.randrange(2) for _ in range(n))
    base, shared = text(200), text(30)
    rows = [(i, text(rnd.randint(20, 90))) for i in range(14)]
    rows += [(20 + i, base) for i in range(4)] + [(30 + i, text(9) + shared + text(9)) for i in range(8)]
    for i in range(8):
        w = list(base)
        for _ in range(rnd.randint(1, 5)):
            w[rnd.randrange(len(w))] = "#"
        rows.append((50 + i, "".join(w)))
    rows += [(60, "a" * 900), (61, "ab" * 300), (62, "a" * 130), (63, None), (64, ""), (65, "short"), (None, base[:300]), (None, text(40)), (None, None)]
    rows += [(20, base), (3, base[50:400] + "!"), (70, base[5:104]), (71, "b" + base[5:105] + "b"), (72, shared * 3)]
    rows += [(80, text(900) + base + text(900)), (81, base[::-1])]
    return [(*r, *"abcdef") for r in rows]


def brute(rows, length):
    """By (doc_id, text): bytes, removed bytes, runs, sha256 of what is left."""
    seen, out = set(), {}
    docs = sorted({(r[0] if r[0] is not None else 2**63, r[1] or "") for r in rows})
    for i, t in docs:
        raw, gone = t.encode(), np.zeros(len(t.encode()), bool)
        for a in range(len(raw) - length + 1):
            w = raw[a : a + length]
            if w in seen:
                gone[a : a + length] = True
            seen.add(w)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[i, t] = (len(raw), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) > 0).sum()), hashlib.sha256(kept).hexdigest(), kept)
    return [out[r[0] if r[0] is not None else 2**63, r[1] or ""] for r in rows]


def told(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in df.collect())


def expected(rows, length):
    return sorted((str(r[0]), *x) for r, x in zip(rows, brute(rows, length)))


@pytest.fixture(scope="module")
def unique():
    """Rows of one doc_id have one text, so that no order among them matters."""
    seen, out = {}, []
    for r in make_rows():
        if r[0] is None and r[1] is not None and None in seen:
            continue
        if seen.setdefault(r[0], r[1] or "") == (r[1] or "") or r[0] is None:
            seen[r[0]] = r[1] or ""
            out.append(r)
    return out


@pytest.mark.parametrize("length, how, setting", [(100, {}, {}), (100, {"pack_bytes": 700}, {"RANGE_ROWS": 50}), (48, {"pack_bytes": 400}, {"PLACE_BYTES": 2000}), (75, {"pack_bytes": 5000}, {"CUT_ROWS": 40, "PLACE_BYTES": 2000})])
def test_against_brute_force(spark, unique, monkeypatch, length, how, setting):
    for k, v in setting.items():
        monkeypatch.setattr(suffixes, k, v)
    docs = spark.createDataFrame(unique, SCHEMA).repartition(3)
    assert told(suffixes.cut_repeated_bytes(docs, length, **how)) == expected(unique, length)


def test_rows_of_one_doc_id(spark):
    """Such of other texts make each other go in one order, such of equal texts don't."""
    text = "".join(random.Random(9).choices("abcdefgh", k=150))
    rows = [(7, text), (7, text), (7, text + "!"), (8, text)]
    got = sorted((r.doc_id, r.n_bytes, r.n_removed) for r in suffixes.cut_repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got in ([(7, 150, 0), (7, 150, 0), (7, 151, 150), (8, 150, 150)], [(7, 150, 150), (7, 150, 150), (7, 151, 0), (8, 150, 150)])


def test_little(spark):
    none = suffixes.cut_repeated_bytes(spark.createDataFrame([], SCHEMA))
    assert none.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"] and not none.count()
    rows = [(1, None, *"abcdef"), (2, "", *"abcdef"), (3, "x" * 99, *"abcdef"), (None, "y" * 100, *"abcdef")]
    assert told(suffixes.cut_repeated_bytes(spark.createDataFrame(rows, SCHEMA))) == expected(rows, 100)
    with pytest.raises(ValueError, match="at least"):
        suffixes.cut_repeated_bytes(spark.createDataFrame(rows, SCHEMA), 20)


def test_query(spark, unique, tmp_path):
    spark.createDataFrame(unique, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = entries.op12_suffix_array(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == [x[:-1] for x in expected(unique, 100)]


def test_all_bytes_and_few(monkeypatch):
    """Words hold as many symbols as fit, and sort like their bytes."""
    assert suffixes.Words.of(list(range(256))).symbols == 7 and suffixes.Words.of([97, 98]).symbols == suffixes.NAME
    rng = np.random.default_rng(2)
    raw = rng.integers(0, 256, 500).astype(np.uint8)
    state = pa.table({"text": pa.array([raw.tobytes()]), "froms": pa.array([[0]]), "lens": pa.array([[500]]), "valid": pa.array([np.packbits(np.ones(500, bool)).tobytes()])})
    s = suffixes.Suffixes(state, 0, suffixes.Words.of(list(range(256))), 100)
    at = s.sampled()
    assert sorted(at.tolist(), key=lambda i: raw[i : i + 7].tobytes()) == at[np.argsort(s.word(at), kind="stable")].tolist()
    assert {int(i) % 9 for i in at} == {4, 5, 7, 8}


def test_any_two_places_share_a_sampled_distance():
    cover = suffixes._COVER
    assert all(any(cover[(i + d) % 9] and cover[(j + d) % 9] for d in range(9)) for i in range(9) for j in range(9))
    assert suffixes._steps(100) == ([0, 27, 54, 63], 2)
    for length in range(48, 140):
        steps, tail = suffixes._steps(length)
        assert steps[-1] + suffixes.NAME + tail + 8 == length and 0 <= tail <= 8 and all(b - a <= suffixes.NAME for a, b in zip(steps, steps[1:]))


def test_windows_of_one_pack_are_compared_byte_for_byte(spark, unique, monkeypatch):
    """Equal hashes of unequal windows settle nothing."""
    real = suffixes._hashes
    monkeypatch.setattr(suffixes, "_hashes", lambda data: real(data) & suffixes._U(0xF000000000))
    pack = next(suffixes._parts(iter([pa.RecordBatch.from_pydict({"doc": [1, 2], "th": [1, 2], "text": ["ab" * 40 + "c" * 60, "x" * 30 + "ab" * 40 + "c" * 60 + "de" * 50]})]), 100, 1 << 20))
    pack = pa.Table.from_batches([pack]).append_column("id", pa.array([5]))
    kept, gone = suffixes._candidates(pack, pa.table({"id": pa.array([], pa.int64()), "keys": pa.array([], pa.binary())}), 100)
    settled = {i for d, a, b in zip(gone[0], gone[2], gone[3]) if d == 2 for i in range(a, b - 99)}
    starts, froms, lens, valid = kept[3], kept[5], kept[6], np.unpackbits(np.frombuffer(kept[7], np.uint8)).astype(bool)
    places = np.concatenate([np.arange(a, a + n) for a, n in zip(froms, lens)])
    left = set((places[valid[: len(places)]] - starts[1]).tolist())
    truly = {i for i in range(30, 71)} | {i for i in range(170, 171)}
    assert settled and settled <= truly and set(range(30, 71)) <= settled | left


def make_state(rng, n, symbols):
    raw = rng.integers(97, 97 + symbols, n).astype(np.uint8)
    lens = [n // 4, n - n // 4]
    valid = np.packbits(rng.integers(0, 2, n).astype(bool)).tobytes()
    return raw, pa.table({"text": pa.array([raw.tobytes()]), "froms": pa.array([[0, n // 4]]), "lens": pa.array([lens]), "valid": pa.array([valid])})


@pytest.mark.parametrize("symbols", [2, 20, 150])
def test_a_pass_makes_the_words_of_its_ranges_only(monkeypatch, symbols):
    """Work over all passes is that of few, however many there are, and each sampled place is in one of them."""
    raw, state = make_state(np.random.default_rng(5), 40_000, symbols)
    words = suffixes.Words.of(list(range(97, 97 + symbols)))
    whole = suffixes.Suffixes(state, 0, words, 100)
    at = whole.sampled()
    w = whole.word(at)
    cuts = np.unique(np.sort(w)[np.arange(1, 20) * len(w) // 20])
    made, real = [], suffixes.Suffixes.word
    monkeypatch.setattr(suffixes.Suffixes, "word", lambda s, places, skip=0: made.append(len(places)) or real(s, places, skip))
    bounds = [None, *cuts.tolist(), None]
    found = [suffixes.Suffixes(state, 0, words, 100).between(a, b) for a, b in zip(bounds, bounds[1:])]
    bucket = np.searchsorted(cuts, w, "right")
    assert all(f.tolist() == at[bucket == i].tolist() and v.tolist() == w[bucket == i].tolist() for i, (f, v) in enumerate(found))
    assert symbols == 2 or sum(made) < 2 * len(at)


def test_distances_and_orders_against_plain_ones():
    rng = np.random.default_rng(6)
    raw, state = make_state(rng, 5000, 9)
    s = suffixes.Suffixes(state, 0, suffixes.Words.of(list(range(97, 106))), 100)
    valid = np.insert(np.unpackbits(np.frombuffer(state.column("valid")[0].as_py(), np.uint8), count=5000), [1250, 5000], 0)
    at = np.arange(s.n)
    assert s.distances(at).tolist() == [sum(int(valid[i - d]) << d for d in range(9) if i >= d) for i in at]
    for most in (1, 3, 1 << 30, (1 << 64) - 1):
        keys = [rng.integers(0, most, 3000, np.uint64, True) for _ in range(3)]
        keys = [k[rng.integers(0, 400, 3000)] for k in keys[:1]] + keys[1:]
        assert suffixes._by_words(keys).tolist() == np.lexsort(keys[::-1]).tolist()
        order, run = suffixes._in_order(keys)
        assert order.tolist() == np.lexsort(keys[::-1]).tolist()
        rows = np.stack([k[order] for k in keys], 1)
        assert run.tolist() == np.concatenate([[0], np.cumsum((rows[1:] != rows[:-1]).any(1))]).tolist()


def test_windows_in_runs_are_alike_where_their_bytes_are():
    """Runs that differ in one byte are told apart window by window."""
    raw = np.frombuffer(b"ab" * 150 + b"c" + b"ab" * 150, np.uint8)
    a, b = np.arange(200, 400), np.arange(0, 200)
    assert suffixes._alike(raw, a, b, 100).tolist() == [raw[i : i + 100].tobytes() == raw[j : j + 100].tobytes() for i, j in zip(a, b)]
    assert suffixes._alike(raw, a[:0], b[:0], 100).tolist() == []
