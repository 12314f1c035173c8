"""Queries op1 to op13 and the pipeline, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packloom.llm import centroids, decontam, langid, mixing, neardup, negatives, quality, sharding, substring, suffixes, tokens, urlfilter, warc
from packloom.llm._store import cut, remove_dir, scratch


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    archives = warc.write_archives(warc.with_revisits(_read(spark, sf_dir, "pages")), folder)
    read = warc.read_archives(archives, with_payload=False).where("kind = 'record'")
    out = cut(read.select(F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"))
    written, found = archives.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0], out.count()
    if found != written:
        raise RuntimeError(f"{written} records were written, {found} were read back")
    remove_dir(folder)
    return out


OP1_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> first_id THEN first_id END AS refers_to
FROM m
"""


def op10_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urlfilter.judge_urls(_read(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


OP10_SQL = r"""
WITH u AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, url,
  translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
l AS (SELECT host FROM p WHERE host <> '' GROUP BY host HAVING max(CASE WHEN lower(substr(url, 1, 8)) = 'https://' THEN 1 ELSE 0 END) = 0),
r AS (SELECT page_id, host, path, CASE
  WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
  WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
  WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
  WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
  WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow'
  WHEN rule IS NOT NULL THEN 'block'
  WHEN host IN (SELECT host FROM l) THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""

def op2_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_read(spark, sf_dir, "documents"))


def op3_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(_read(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH d AS (SELECT r, doc_id, coalesce(CAST(doc_id AS VARCHAR), 'row ' || r) AS doc, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
  list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l FROM (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents)),
g AS (SELECT r, i, array_to_string(w[i:i+2], ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
twice AS (SELECT r, s FROM g GROUP BY r, s HAVING count(*) > 1),
rep AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT g.r, unnest(range(i, i + 3)) AS j FROM g JOIN twice t ON g.r = t.r AND g.s = t.s) GROUP BY r),
n AS (SELECT r, doc, source, trim(regexp_replace(lower(unnest(l)), '[\x20\x09-\x0D]+', ' ', 'g')) AS line FROM d),
h AS (SELECT source, count(DISTINCT doc) AS host_docs FROM d GROUP BY source),
often AS (SELECT n.source, line FROM n JOIN h ON n.source IS NOT DISTINCT FROM h.source GROUP BY n.source, line, host_docs
  HAVING count(DISTINCT doc) > 10 AND 100 * count(DISTINCT doc) > host_docs),
c AS (SELECT r, sum(length(n.line)) AS total, sum(CASE WHEN o.line IS NOT NULL THEN length(n.line) ELSE 0 END) AS gone
  FROM n LEFT JOIN often o ON n.line = o.line AND n.source IS NOT DISTINCT FROM o.source GROUP BY r),
b AS (SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
  len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(total, 0) AS total, coalesce(gone, 0) AS gone
  FROM d LEFT JOIN rep ON d.r = rep.r LEFT JOIN c ON d.r = c.r),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND 100 * (total - gone) >= 30 * total AS kept FROM f
"""


def op4_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_read(spark, sf_dir, "documents"))


def op5_block_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_shares(_read(spark, sf_dir, "documents"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_rans_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "tokens")
    out = cut(tokens.token_rows(_read(spark, sf_dir, "documents"), folder, tokenizer_path()))
    remove_dir(folder)
    return out


#: Words of a whole text, A-Z lower-cased, and its distinct 5-word shingles (fewer words: the whole).
_SHINGLES = r"""
SELECT DISTINCT {id}, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
FROM (SELECT {id}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM {table})
"""


def op6_containment_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leak_pairs(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


OP6_SQL = f"""
WITH d AS ({_SHINGLES.format(id="doc_id", table="documents")}), b AS ({_SHINGLES.format(id="item_id", table="benchmark")}),
n AS (SELECT item_id, count(*) AS n FROM b GROUP BY item_id),
x AS (SELECT d.doc_id, b.item_id, count(*) AS n_shared FROM d JOIN b ON d.s = b.s GROUP BY 1, 2)
SELECT doc_id, x.item_id, n AS n_item_shingles, n_shared, n_shared / n AS containment
FROM x JOIN n ON x.item_id = n.item_id WHERE 100 * n_shared >= 75 * n
"""


def op7_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_read(spark, sf_dir, "documents"))


OP7_SQL = f"""
WITH RECURSIVE s AS MATERIALIZED ({_SHINGLES.format(id="doc_id", table="documents")}),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
x AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT u, v FROM x JOIN n nu ON nu.doc_id = u JOIN n nv ON nv.doc_id = v WHERE 100 * k >= 75 * (nu.n + nv.n - k)),
r(doc_id, reach) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.v FROM r JOIN e ON r.reach = e.u),
c AS (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""


def op9_debruijn_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.cut_repeats(_read(spark, sf_dir, "documents"), with_text=False)


OP9_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20),
g AS (SELECT p.doc_id, i, array_to_string(w[i:i+19], ' ') AS s FROM p JOIN d USING (doc_id)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM g),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM f WHERE k > 1),
gl AS (SELECT doc_id, list(j) AS js FROM gone GROUP BY doc_id),
x AS (SELECT d.doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d),
k AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.j) AS kept FROM x LEFT JOIN gone ON x.doc_id = gone.doc_id AND x.j = gone.j WHERE gone.j IS NULL GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(len(js), 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN gl ON d.doc_id = gl.doc_id LEFT JOIN k ON d.doc_id = k.doc_id
"""

def op11_elkan_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(_read(spark, sf_dir, "embeddings"))


def _op11_sql(rounds: int = centroids.ROUNDS) -> str:
    """The rounds one after the other; sums are divided towards minus infinity."""
    nearest = """SELECT r, k, d FROM (SELECT r, k, d, row_number() OVER (PARTITION BY r ORDER BY d, k) AS n
  FROM (SELECT x.r, c.k, sum((x.x - c.c) * (x.x - c.c))::BIGINT AS d FROM x JOIN c{i} c ON x.i = c.i GROUP BY x.r, c.k)) WHERE n = 1"""
    steps = "".join(f""",
a{i} AS MATERIALIZED ({nearest.format(i=i)}),
c{i + 1} AS MATERIALIZED (SELECT c.k, c.i, coalesce(((s - ((s % n) + n) % n) // n)::BIGINT, c.c) AS c FROM c{i} c
  LEFT JOIN (SELECT a.k, x.i, sum(x.x) AS s, count(*) AS n FROM a{i} a JOIN x ON a.r = x.r GROUP BY a.k, x.i) m ON c.k = m.k AND c.i = m.i)""" for i in range(rounds))
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT r, unnest(v) AS x, unnest(range(1, 65)) AS i FROM kept),
c0 AS MATERIALIZED (SELECT k, unnest(v) AS c, unnest(range(1, 65)) AS i
  FROM (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS k, v FROM kept WHERE vec_id IS NOT NULL) WHERE k < 8){steps},
e AS MATERIALIZED ({nearest.format(i=rounds)}),
s AS (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY k)
SELECT vec_id, e.k::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY e.k))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM e JOIN kept ON e.r = kept.r JOIN s ON e.k = s.k
"""


def op12_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.cut_repeated_bytes(_read(spark, sf_dir, "documents"), with_text=False)


#: Bytes as hexadecimal digits, two each.
OP12_SQL = """
WITH d AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS i FROM d WHERE length(h) >= 200),
g AS (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 200)) AS s FROM p),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM g),
m AS (SELECT doc_id, i, max(i) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM f WHERE k > 1),
r AS (SELECT doc_id, i, sum(CASE WHEN b IS NULL OR i > b + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM m),
s AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS e FROM r GROUP BY doc_id, run),
k AS (SELECT s.doc_id, count(*) AS n_spans, sum(e - a)::BIGINT AS n_removed, max(e) AS last,
  string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
  FROM (SELECT *, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM s) s JOIN d ON s.doc_id = d.doc_id GROUP BY s.doc_id)
SELECT d.doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)


OP13_SQL = """
WITH r AS MATERIALIZED (SELECT row_number() OVER () AS u, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.u, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
  coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 50 = 0 AND b.vec_id IS DISTINCT FROM a.vec_id OR a.vec_id % 50 = 0 AND a.label <> b.label),
p AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY score DESC, vec_id NULLS LAST) AS k FROM s WHERE same),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, (row_number() OVER (PARTITION BY p.u, p.k ORDER BY s.score DESC, s.vec_id NULLS LAST))::INTEGER AS rank,
  s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON p.u = s.u AND p.k <= 5 AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT * FROM n WHERE rank <= 3
"""

QUERIES = {
    "op1_warc_salvage": op1_warc_salvage,
    "op2_minimax_shards": op2_minimax_shards,
    "op3_line_frequency": op3_line_frequency,
    "op4_string_kernel": op4_string_kernel,
    "op5_block_mix": op5_block_mix,
    "op6_containment_search": op6_containment_search,
    "op7_superminhash": op7_superminhash,
    "op8_rans_tokens": op8_rans_tokens,
    "op9_debruijn_spans": op9_debruijn_spans,
    "op10_url_cascade": op10_url_cascade,
    "op11_elkan_centroids": op11_elkan_centroids,
    "op12_suffix_array": op12_suffix_array,
    "op13_hard_negatives": op13_hard_negatives,
}
SQL = {
    "op1_warc_salvage": OP1_SQL,
    "op3_line_frequency": OP3_SQL,
    "op6_containment_search": OP6_SQL,
    "op7_superminhash": OP7_SQL,
    "op9_debruijn_spans": OP9_SQL,
    "op10_url_cascade": OP10_SQL,
    "op11_elkan_centroids": _op11_sql(),
    "op12_suffix_array": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
