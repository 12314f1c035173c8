"""The pipeline's stages, each held against its operator's plain meaning on its own input."""

import zlib
from collections import Counter

import numpy as np
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from packloom.llm import decontam, langid, mixing, neardup
from packloom.llm.entries import tokenizer_path
from test_llm_operators import SCHEMA, make_docs, shingles, words


def test_stages(spark, tmp_path):
    rows = make_docs()
    folder = str(tmp_path / "sf")
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    item = " ".join(words(rows[7][1])[:20])
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, outs = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/{i}")
        outs.append((docs, spark.read.parquet(f"{folder}/{i}")))
        docs = outs[-1][1]
        assert docs.count() > 0 and (i == 4 or docs.columns == columns)

    key = lambda df: Counter(map(str, df.collect()))
    before, after = outs[0]
    kept = {r.doc_id for r in langid.identify(before).collect() if r.lang_pred != "und" and r.score >= corpus_pipeline.MIN_SCORE}
    assert None in kept  # a null doc_id with a text
    assert key(after) == key(before.where("text IS NOT NULL").where(before.doc_id.isNull() | before.doc_id.isin(sorted(kept - {None})))) and 150 not in kept
    before, after = outs[1]
    kept = {r.doc_id for r in neardup.near_duplicates(before).collect() if r.kept}
    assert key(after) == key(before.where(before.doc_id.isNull() | before.doc_id.isin(sorted(kept - {None})))) and len({r.doc_id for r in after.collect()} & set(range(100, 105))) == 1
    before, after = outs[2]
    bad = {r.doc_id for r in before.collect() if 100 * len(shingles(item) & shingles(r.text)) >= 75 * len(shingles(item))}
    assert bad == {7} and key(after) == key(before.where("doc_id IS NULL OR doc_id <> 7"))
    before, after = outs[3]
    taken = Counter((r.doc_id, r.taken) for r in mixing.mix_shares(before).collect() if r.taken)
    assert Counter((r.doc_id, len(words(r.text))) for r in after.collect()) == taken
    before, after = outs[4]
    tok, start, expected = Tokenizer.from_file(tokenizer_path()), 0, Counter()
    h = lambda t: np.uint64(xxhash.xxh64_intdigest(t.encode(), 42)).astype(np.int64)
    for r in sorted(before.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, h(r.text))):
        ids = [*tok.encode(r.text, add_special_tokens=False).ids, 0]
        expected[r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        start += len(ids)
    assert Counter(tuple(r) for r in after.collect()) == expected
    assert Counter(tuple(r) for r in corpus_pipeline.run(spark, folder).collect()) == expected
    assert decontam.leak_pairs(outs[2][1], spark.read.parquet(f"{folder}/benchmark.parquet")).count() == 0


def test_language_stage_rejects_unlearned_languages(spark, tmp_path):
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    clean = [r[:5] for r in make_docs() if r[0] is not None and r[0] < 60]
    learned = [(400 + i, " ".join(t.split()[:60]), None, s, 0) for i, t, _, s, _ in clean]
    words_of = {
        "el": "το σπίτι και ο ποταμός είναι πράσινος στη χώρα",
        "fi": "hyvä päivä kaikki pidämme kylmästä jäätelöstä myös syksyllä",
        "junk": "xqzj vkwp zzxq jjkq wvxz qpzk jxvq kkzw",
    }
    bad = [(300 + i, " ".join(w.split() * 8), None, "src0", 0) for i, w in enumerate(words_of.values())]
    docs = spark.createDataFrame([*clean, *learned, *bad], columns)
    kept = {r.doc_id for r in corpus_pipeline.language(spark, docs, str(tmp_path)).collect()}
    assert kept == {r[0] for r in [*clean, *learned]}


def test_language_stage_rejects_with_four_languages(spark, tmp_path):
    vocab = {"en": "the of and house water green thing with that", "fr": "le la été maison rivière où vert chose dans", "de": "der die und ist nicht straße wasser grün über", "es": "el los niño agua verde cosa para señor más"}
    rows = [(100 * k + i, " ".join((v.split() * 9)[i % 9 : i % 9 + 50]), lang, "s", 0) for k, (lang, v) in enumerate(vocab.items()) for i in range(20)]
    rows.append((800, " ".join(f"{v} " * 150 for v in vocab.values()), None, "s", 0))  # long, and of all four
    model = langid.fit([(r[1], r[2]) for r in rows if r[2]])
    texts = [rows[-1][1], *(r[1] for r in rows[:70]), rows[-1][1], rows[3][1]]  # over a slab's end
    assert langid.UNKNOWN not in langid._predict(model, texts)[0]
    bad = [(900, "дом и река " * 20, None, "s", 0), (901, "xqzj vkwp zzxq " * 20, None, "s", 0)]
    docs = spark.createDataFrame([*rows, *bad], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in corpus_pipeline.language(spark, docs, str(tmp_path)).collect()} == {r[0] for r in rows}


def test_without_documents(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []
    rows = [(1, None, None, None, 0), (None, None, "en", "a", None), (2, "", "en", "b", 0), (3, " \n", None, "b", 2)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/no/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/no/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{folder}/no").collect() == []
