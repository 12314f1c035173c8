"""The query catalog: each operator over the tables, with the same result as DuckDB SQL where SQL can express it."""

from __future__ import annotations

import contextlib
import itertools
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from packloom.functions import files, ids, text as T
from packloom.operators import capabilities, classify, contracts, dictionary, duplicates, members, terms, timings
from packloom.plans import dictionaries, sinks
from packloom.plans import fixtures as X
from packloom.plans import pack as pack_plan
from packloom.plans import views as V
from packloom.sources.shared import remove_dir, scratch, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _bars(counts: str) -> str:
    """SQL for a map as text, of a query of (k, n)."""
    return f"(SELECT coalesce(string_agg(k || '=' || n, '|' ORDER BY k), '') FROM ({counts}))"


def _as_text(*maps: str) -> dict:
    return {m: F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|") for m in maps}


# Duplicates


def _flat(groups: DataFrame) -> DataFrame:
    """A row a group, all ids of which are one text: so much is asked for here, the operator's own rows are bounded."""
    whole = groups.groupBy("group_id", "duplicate_type", "content_hash", "recommended_canonical_source_id").agg(F.array_sort(F.collect_list(F.struct("part", F.array_join("source_ids", "|").alias("s")))).alias("p"))
    return whole.withColumn("source_ids", F.array_join(F.transform("p", lambda x: x["s"]), "|")).drop("p")


def _group_sql(keys: str, having: str, kind: str, content: str, where: str = "") -> str:
    return f"""SELECT 'dup_' || substr(sha256(duplicate_type || '|' || source_ids), 1, 16) AS group_id, duplicate_type, source_ids, content_hash, recommended_canonical_source_id FROM (
  SELECT {kind} AS duplicate_type, string_agg(source_id, '|' ORDER BY lower(logical_path), source_id) AS source_ids, {content} AS content_hash,
    first(source_id ORDER BY lower(logical_path), source_id) AS recommended_canonical_source_id FROM pack {where} GROUP BY {keys} HAVING {having})"""


_CONTENT = _group_sql("file_hash", "count(*) > 1", "CASE WHEN count(DISTINCT file_name) > 1 THEN 'same_content_different_filenames' ELSE 'identical_content' END", "file_hash")
_PATH = _group_sql("logical_path", "count(*) > 1", "'duplicate_relative_path'", "NULL")
_MEMBER = _group_sql("parent_archive_source_id, archive_member_path", "count(*) > 1", "'duplicate_archive_member_path'", "NULL", "WHERE archive_member_path IS NOT NULL")
_NAME = _group_sql("lower(file_name)", "count(DISTINCT file_hash) > 1", "'same_filename_different_content'", "NULL")


@query(f"WITH {V.PACK} {_CONTENT}")
def dup_content_groups(spark, d):
    return _flat(duplicates.content_groups(V.pack(spark, d)))


@query(f"WITH {V.PACK} {_PATH}")
def dup_path_groups(spark, d):
    return _flat(duplicates.path_groups(V.pack(spark, d)))


@query(f"WITH {V.PACK} {_MEMBER}")
def dup_member_groups(spark, d):
    return _flat(duplicates.member_groups(V.pack(spark, d)))


@query(f"WITH {V.PACK} {_NAME}")
def dup_name_diff_content(spark, d):
    return _flat(duplicates.name_groups(V.pack(spark, d)))


@query(f"WITH {V.PACK} {_CONTENT} UNION ALL {_PATH} UNION ALL {_MEMBER} UNION ALL {_NAME}")
def dup_all_union(spark, d):
    return _flat(duplicates.all_groups(V.pack(spark, d)))


@query(f"""WITH {V.PACK}, kind AS (SELECT rank, key0, key1, source_id, logical_path, file_hash, file_name FROM (SELECT 0 AS rank, file_hash AS key0, NULL AS key1, * FROM pack UNION ALL SELECT 1, logical_path, NULL, * FROM pack
    UNION ALL SELECT 2, parent_archive_source_id, archive_member_path, * FROM pack WHERE archive_member_path IS NOT NULL UNION ALL SELECT 3, lower(file_name), NULL, * FROM pack)),
  g AS (SELECT rank, key0, key1, string_agg(source_id, '|' ORDER BY lower(logical_path), source_id) AS every,
    CASE rank WHEN 0 THEN CASE WHEN count(DISTINCT file_name) > 1 THEN 'same_content_different_filenames' ELSE 'identical_content' END WHEN 1 THEN 'duplicate_relative_path'
      WHEN 2 THEN 'duplicate_archive_member_path' ELSE 'same_filename_different_content' END AS duplicate_type
    FROM kind GROUP BY rank, key0, key1 HAVING CASE WHEN rank = 3 THEN count(DISTINCT file_hash) > 1 ELSE count(*) > 1 END)
  SELECT 'dup_' || substr(sha256(duplicate_type || '|' || every), 1, 16) AS group_id, duplicate_type,
    row_number() OVER (PARTITION BY kind.rank, kind.key0, kind.key1 ORDER BY lower(logical_path), source_id) AS position, source_id
  FROM kind JOIN g ON kind.rank = g.rank AND kind.key0 IS NOT DISTINCT FROM g.key0 AND kind.key1 IS NOT DISTINCT FROM g.key1""")
def dup_group_members(spark, d):
    return duplicates.group_members(duplicates.all_groups(V.pack(spark, d), part=16), part=16)


@query(f"WITH {V.PACK} SELECT file_hash, first(source_id ORDER BY lower(logical_path), source_id) AS canonical, count(*) AS n FROM pack GROUP BY file_hash")
def canonical_source(spark, d):
    order = F.struct(T.casefold(F.col("logical_path")), F.col("source_id"))
    return V.pack(spark, d).groupBy("file_hash").agg(F.min_by("source_id", order).alias("canonical"), F.count(F.lit(1)).alias("n"))


# Identifiers


@query(f"WITH {V.PACK} SELECT doc_id, source_id FROM pack")
def source_ids(spark, d):
    return V.pack(spark, d).select("doc_id", "source_id")


@query(f"WITH {V.PACK} SELECT doc_id, 'sha256:' || file_hash AS content_identity FROM pack")
def content_identity(spark, d):
    return V.pack(spark, d).select("doc_id", ids.content_identity("file_hash").alias("content_identity"))


@query(f"WITH {V.PACK} SELECT doc_id, 'src_' || substr(sha256(logical_path || chr(10) || file_hash), 1, 16) AS source_id FROM pack")
def legacy_source_ids(spark, d):
    return V.pack(spark, d).select("doc_id", ids.path_source_id("logical_path", "file_hash").alias("source_id"))


_LABEL = """label AS (SELECT *, lower(logical_path || ' ') AS t FROM pack),
labelled AS (SELECT *, CASE WHEN file_type = 'zip' THEN 'archive' WHEN file_type = 'image' THEN 'photograph/image'
  WHEN file_type IN ('xlsx', 'xls', 'csv') THEN CASE WHEN contains(t, 'maintenance') THEN 'maintenance schedule' WHEN contains(t, 'schedule') OR contains(t, 'matrix') THEN 'equipment schedule' ELSE 'spreadsheet' END
  WHEN contains(t, 'certificat') THEN 'individual certificate' WHEN contains(t, 'commissioning') THEN 'commissioning report' WHEN regexp_matches(t, 'drawing|layout|plan') THEN 'drawing set'
  WHEN contains(t, 'specification') THEN 'technical specification' WHEN regexp_matches(t, 'supplier|manufacturer') THEN 'supplier manual' WHEN regexp_matches(t, 'o&m|operation|maintenance') THEN 'O&M manual'
  WHEN contains(t, 'manual') THEN 'building manual' ELSE 'unknown' END AS primary_label FROM label),
c AS (SELECT *, 'cls_' || substr(sha256(source_id || '|' || primary_label || '|0.1.0'), 1, 16) AS classification_id,
  CASE primary_label WHEN 'archive' THEN 0.95 WHEN 'photograph/image' THEN 0.85 WHEN 'individual certificate' THEN 0.8 WHEN 'commissioning report' THEN 0.82 WHEN 'drawing set' THEN 0.78 WHEN 'technical specification' THEN 0.78
    WHEN 'supplier manual' THEN 0.72 WHEN 'O&M manual' THEN 0.72 WHEN 'building manual' THEN 0.7 WHEN 'unknown' THEN CASE WHEN file_type = 'pdf' THEN 0.25 ELSE 0.1 END ELSE 0.85 END AS confidence,
  CASE WHEN file_type IN ('xlsx', 'xls', 'csv') THEN 'spreadsheet' WHEN primary_label = 'individual certificate' THEN 'certificate' WHEN primary_label = 'building manual' THEN 'manual' WHEN primary_label = 'unknown' AND file_type = 'pdf' THEN 'pdf' ELSE '' END AS secondary,
  CASE WHEN primary_label = 'individual certificate' THEN 'certificate pack' WHEN primary_label = 'building manual' THEN 'O&M manual' WHEN primary_label = 'unknown' AND file_type = 'pdf' THEN 'mixed document' ELSE '' END AS alternative FROM labelled)"""


@query(f"WITH {V.PACK}, {_LABEL} SELECT classification_id, source_id AS subject_id, primary_label, CAST(confidence AS DOUBLE) AS confidence, secondary, alternative FROM c")
def classify_sources(spark, d):
    c = classify.classify_sources(V.pack(spark, d))
    alternative = F.array_join(F.transform("alternative_labels", lambda x: x["label"]), "|")
    return c.select("classification_id", "subject_id", "primary_label", "confidence", F.array_join("secondary_labels", "|").alias("secondary"), alternative.alias("alternative"))


@query(f"WITH {V.PACK}, {_LABEL} SELECT classification_id FROM c")
def classification_ids(spark, d):
    return classify.classify_sources(V.pack(spark, d)).select("classification_id")


@query(f"WITH {V.PACK}, {_LABEL} SELECT primary_label, count(*) AS n FROM c GROUP BY primary_label")
def classification_counts(spark, d):
    return dictionary.histogram(classify.classify_sources(V.pack(spark, d)), "primary_label", "primary_label")


@query(f"WITH {V.PACK}, {_LABEL} SELECT count(*) AS n, count(*) FILTER (primary_label = 'unknown') AS unknown FROM c")
def unknown_rate(spark, d):
    return classify.classify_sources(V.pack(spark, d)).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("primary_label") == "unknown").alias("unknown"))


@query(f"WITH {V.PACK}, {_LABEL}, l AS (SELECT DISTINCT 'doc ' || quality AS override_label, doc_id FROM labels WHERE toxic = 1) SELECT source_id AS subject_id, primary_label, coalesce(override_label, primary_label) AS effective_label FROM c LEFT JOIN l ON c.doc_id = l.doc_id")
def effective_label(spark, d):
    pack = V.pack(spark, d)
    human = V.table(spark, d, "labels").where("toxic = 1").select("doc_id", F.concat(F.lit("doc "), "quality").alias("override_label")).distinct()
    human = human.join(pack.select("doc_id", F.col("source_id").alias("subject_id")), "doc_id")
    return classify.with_overrides(classify.classify_sources(pack), human).select("subject_id", "primary_label", "effective_label")


# File signatures

#: A header without a NUL that is UTF-8 to its last byte is text: the 513th byte doesn't go on with a sign.
_BODY = """page0 AS (SELECT page_id, coalesce(html, '') AS html, CASE page_id % 8 WHEN 0 THEN '%PDF-1.4 /Type /Page /Type/Page ' WHEN 1 THEN 'PK' || chr(3) || chr(4) WHEN 2 THEN 'GIF89a' ELSE '' END AS head,
  'p' || page_id || CASE page_id % 6 WHEN 0 THEN '.xlsx' WHEN 1 THEN '.csv' WHEN 2 THEN '.JSON' WHEN 3 THEN '.zip' WHEN 4 THEN '.md' ELSE '' END AS name FROM pages),
page1 AS (SELECT page_id, name, head, head || html AS body, hex(encode(head || html)) AS bytes FROM page0),
page AS (SELECT page_id, name, body, CASE WHEN starts_with(head, '%PDF') THEN 'pdf' WHEN starts_with(head, 'PK') THEN CASE WHEN ends_with(name, '.xlsx') THEN 'xlsx' ELSE 'zip' END WHEN ends_with(name, '.zip') THEN 'zip'
  WHEN starts_with(head, 'GIF') THEN 'image' WHEN ends_with(name, '.csv') THEN 'csv' WHEN ends_with(name, '.JSON') THEN 'json' WHEN ends_with(name, '.md') THEN 'text'
  WHEN bytes <> '' AND NOT regexp_matches(substr(bytes, 1, 1024), '^(..)*00') AND NOT (substr(bytes, 1025, 2) >= '80' AND substr(bytes, 1025, 2) < 'C0') THEN 'text' ELSE 'unknown' END AS kind FROM page1)"""


def _pages(spark, d):
    t = V.table(spark, d, "pages").select("page_id", F.coalesce("html", F.lit("")).alias("html"))
    i = F.col("page_id")
    head = F.when(i % 8 == 0, "%PDF-1.4 /Type /Page /Type/Page ").when(i % 8 == 1, "PK\3\4").when(i % 8 == 2, "GIF89a").otherwise("")
    name = F.concat(F.lit("p"), i, V._pick((".xlsx", ".csv", ".JSON", ".zip", ".md", ""), i))
    t = t.select("page_id", name.alias("name"), F.concat(head, "html").cast("binary").alias("content"))
    return t.withColumn("kind", files.file_type(F.col("content"), F.col("name")))


@query(f"WITH {_BODY} SELECT page_id, kind FROM page")
def sniff_types(spark, d):
    return _pages(spark, d).select("page_id", "kind")


@query(f"WITH {_BODY} SELECT kind, count(*) AS n FROM page GROUP BY kind")
def sniff_counts(spark, d):
    return dictionary.histogram(_pages(spark, d), "kind", "kind")


@query(f"WITH {_BODY} SELECT page_id, CASE WHEN n > 0 THEN n END AS page_count FROM (SELECT page_id, len(regexp_extract_all(body, '/Type ?/Page')) AS n FROM page)")
def marker_count(spark, d):
    return _pages(spark, d).select("page_id", files.pdf_pages(F.col("content")).cast("bigint").alias("page_count"))


@query("SELECT doc_id, substr(regexp_replace(coalesce(text, ''), '\\r\\n?', chr(10), 'g'), 1, 500) AS header_text FROM documents")
def text_header_500(spark, d):
    t = V.table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("content"))
    return t.select("doc_id", files.text_header(F.col("content")).alias("header_text"))


# Packs

_IGNORED = "(starts_with(lower(file_name), '~$') OR lower(file_name) IN ('.ds_store', 'thumbs.db', 'desktop.ini'))"


@query(f"WITH {V.PACK} SELECT doc_id FROM pack WHERE {_IGNORED}")
def ignored_files(spark, d):
    return V.pack(spark, d).where(files.is_ignored(F.col("file_name"))).select("doc_id")


@query(f"WITH {V.PACK} SELECT doc_id, CASE WHEN {_IGNORED} THEN 'ignored' WHEN doc_id % 17 = 0 THEN 'registered_with_warnings' ELSE 'registered' END AS disposition FROM pack")
def dispositions(spark, d):
    kind = F.when(F.col("doc_id") % 17 == 0, "unknown").otherwise(F.col("file_type"))
    return V.pack(spark, d).select("doc_id", files.disposition(F.col("file_name"), kind).alias("disposition"))


@query(f"WITH {V.PACK} SELECT logical_path FROM pack WHERE NOT {_IGNORED} AND doc_id % 17 = 0")
def unsupported_files(spark, d):
    kind = F.when(F.col("doc_id") % 17 == 0, "unknown").otherwise(F.col("file_type"))
    return V.pack(spark, d).where(files.disposition(F.col("file_name"), kind) == "registered_with_warnings").select("logical_path")


@query(f"WITH {V.PACK} SELECT coalesce(nullif(regexp_extract(lower(file_name), '[^/](\\.[^./]+)$', 1), ''), '<none>') AS extension, count(*) AS n FROM pack GROUP BY 1")
def ext_histogram(spark, d):
    return dictionary.histogram(V.pack(spark, d), F.coalesce(T.or_null(files.extension(F.col("file_name"))), F.lit("<none>")), "extension")


@query(f"WITH {V.PACK} SELECT lower(file_name) AS name, count(*) AS n FROM pack GROUP BY 1 HAVING count(*) > 1")
def duplicate_names(spark, d):
    return V.pack(spark, d).groupBy(T.casefold(F.col("file_name")).alias("name")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query(f"""WITH RECURSIVE {V.PACK}, {_LABEL}, {V.MEMBERS}, ok AS (SELECT * FROM pack WHERE NOT {_IGNORED}), counts AS (SELECT count(DISTINCT archive) AS archives, count(*) AS members FROM entry),
g AS (SELECT count(*) FILTER (n > 1 AND names = 1) AS same FROM (SELECT count(*) AS n, count(DISTINCT file_name) AS names FROM ok GROUP BY file_hash)),
n AS (SELECT count(*) AS differ FROM (SELECT lower(file_name) FROM ok GROUP BY 1 HAVING count(DISTINCT file_hash) > 1)),
w AS (SELECT unnest(issues) AS k FROM entry UNION ALL SELECT 'UNSUPPORTED_FILE_TYPE' FROM ok WHERE doc_id % 17 = 0)
SELECT (SELECT count(*) FROM pack) AS files_discovered, 0 AS files_rejected, (SELECT count(*) FROM pack WHERE {_IGNORED}) AS files_ignored, (SELECT count(*) FROM ok) AS files_registered,
  (SELECT CAST(coalesce(sum(size_bytes), 0) AS BIGINT) FROM ok) AS total_source_bytes, archives, members AS archive_members, same AS identical_content_groups, differ AS same_name_different_content_findings,
  (SELECT count(*) FROM c WHERE primary_label = 'unknown' AND NOT {_IGNORED}) AS unknown_classifications, {{kinds}} AS files_by_detected_type, {{labels}} AS classification_counts, {{codes}} AS warnings_by_code FROM counts, g, n""".format(
    kinds="(SELECT string_agg(k || '=' || n, '|' ORDER BY k) FROM (SELECT file_type AS k, count(*) AS n FROM pack GROUP BY 1))",
    labels=f"(SELECT string_agg(k || '=' || n, '|' ORDER BY k) FROM (SELECT primary_label AS k, count(*) AS n FROM c WHERE NOT {_IGNORED} GROUP BY 1))",
    codes="(SELECT string_agg(k || '=' || n, '|' ORDER BY k) FROM (SELECT k, count(*) AS n FROM w GROUP BY 1))",
))
def pack_summary(spark, d):
    """The plan's summary, over sources, archives and members that the tables stand for."""
    odd = F.col("doc_id") % 17 == 0
    with _scratch(spark, "pack") as folder:  # as the engine does, tables that are read several times are kept
        rows = written(V.pack(spark, d), f"{folder}/rows")
        found = rows.select("doc_id", F.col("logical_path").alias("relative_path"), F.col("file_type").alias("detected_type"), files.disposition(F.col("file_name"), F.when(odd, "unknown").otherwise(F.col("file_type"))).alias("disposition"), F.lit(None).cast("string").alias("error"))
        sources = rows.where(~files.is_ignored(F.col("file_name")))
        checked = written(_checked(spark, d).select("archive", "member_path", "uncompressed_size", "status", "issues", F.col("archive").cast("string").alias("archive_path"), F.lit(None).cast("string").alias("failure")), f"{folder}/checked")
        archives = members.archive_summaries(checked).withColumns({"archive_path": F.col("archive").cast("string"), "corrupt": F.lit(None).cast("string"), "issues": F.array().cast("array<string>")})
        out = pack_plan.pack_summary(found, sources, archives, duplicates.all_groups(sources), classify.classify_sources(sources), pack_plan.pack_issues(found, archives, checked))
        return _kept(out.withColumns(_as_text("files_by_detected_type", "classification_counts", "warnings_by_code")))


# Dictionary cells and headers

_WS = "[ \\t\\n\\r\\x0b\\x0c\\x1c-\\x1f]+"


@query(f"SELECT doc_id, nullif(trim(regexp_replace(text, '{_WS}', ' ', 'g')), '') AS cell FROM documents")
def clean_cells(spark, d):
    return V.table(spark, d, "documents").select("doc_id", T.clean_cell(F.col("text")).alias("cell"))


@query(f"SELECT p_partkey, trim(regexp_replace(replace(lower(' ' || p_name || '__ID  ' || p_type), '_', ' '), '{_WS}', ' ', 'g')) AS header FROM part")
def normalize_headers(spark, d):
    t = V.table(spark, d, "part").select("p_partkey", F.concat(F.lit(" "), "p_name", F.lit("__ID  "), "p_type").alias("h"))
    return t.select("p_partkey", T.normalize_header(F.col("h")).alias("header"))


_HEADERS = f"h AS (SELECT p_partkey AS pos, trim({V._pick_sql(V.HEADERS, 'p_partkey')}) AS b FROM part), n AS (SELECT pos, coalesce(nullif(b, ''), 'blank_column_' || pos) AS b FROM h)"


def _headers(spark, d):
    return V.table(spark, d, "part").select(F.col("p_partkey").alias("pos"), V._pick(V.HEADERS, F.col("p_partkey")).alias("header"))


@query(f"WITH {_HEADERS} SELECT pos, CASE WHEN k = 1 THEN b ELSE b || '__' || k END AS name FROM (SELECT pos, b, row_number() OVER (PARTITION BY b ORDER BY pos) AS k FROM n)")
def unique_headers(spark, d):
    return dictionary.unique_headers(_headers(spark, d)).select("pos", "name")


@query(f"WITH {_HEADERS} SELECT b AS header, count(*) AS n FROM h GROUP BY b HAVING b = '' OR count(*) > 1")
def dup_blank_headers(spark, d):
    return _headers(spark, d).groupBy(T.stripped(F.col("header")).alias("header")).agg(F.count(F.lit(1)).alias("n")).where("header = '' OR n > 1")


@query("WITH c AS (SELECT event_type AS col, CASE user_id % 3 WHEN 0 THEN 'str' WHEN 1 THEN CASE WHEN event_type = 'click' THEN 'str' ELSE 'int' END ELSE CASE WHEN event_type = 'click' THEN 'str' ELSE 'float' END END AS t, CASE WHEN event_id % 9 = 0 THEN '  ' ELSE CAST(event_id AS VARCHAR) END AS v FROM events) SELECT col AS \"column\", string_agg(DISTINCT t, '|' ORDER BY t) AS types FROM c WHERE trim(v) <> '' GROUP BY col HAVING count(DISTINCT t) > 1")
def mixed_type_columns(spark, d):
    other = lambda k: F.when(F.col("event_type") == "click", "str").otherwise(k)
    kind = F.when(F.col("user_id") % 3 == 0, "str").when(F.col("user_id") % 3 == 1, other("int")).otherwise(other("float"))
    value = F.when(F.col("event_id") % 9 == 0, "  ").otherwise(F.col("event_id").cast("string"))
    cells = V.table(spark, d, "events").select(F.col("event_type").alias("column"), kind.alias("type"), value.alias("value"))
    return dictionary.mixed_types(cells).select("column", F.array_join("types", "|").alias("types"))


# Dictionary rows

_MAPPING = dictionary.bind_columns(dictionary.TEMPLATE, [a["aliases"][0] for a in dictionary.TEMPLATE["columns"].values()])


def _results(spark, d):
    return dictionary.normalize_rows(V.dictionary(spark, d), _MAPPING, "part", "part.parquet")


_OK = "disposition IN ('normalized', 'normalized_with_warnings')"
_ISSUES = """issues AS (SELECT row_number, unnest((CASE WHEN expected_field = '' THEN ['BLANK_MANDATORY_COLUMN|expected_field'] ELSE [] END) || (CASE WHEN sub_domain = '' THEN ['BLANK_MANDATORY_COLUMN|sub_domain'] ELSE [] END)
  || (CASE WHEN requirement_name = '' AND definition = '' THEN ['MISSING_DESCRIPTIVE_FIELD|requirement_text'] ELSE [] END)) AS i FROM dict WHERE NOT blank)"""


@query(f"WITH {V.DICT} SELECT row_number FROM dict WHERE blank")
def blank_rows(spark, d):
    return V.dictionary(spark, d).where(dictionary.blank_row(F.col("cells"))).select("row_number")


@query(f"WITH {V.DICT}, {_ISSUES} SELECT row_number, split_part(i, '|', 1) AS issue_code, split_part(i, '|', 2) AS source_column FROM issues")
def mandatory_issues(spark, d):
    rows = dictionary.issue_rows(_results(spark, d)).where("severity = 'error' AND issue_code <> 'TARGET_SPEC_VALIDATION_FAILED'")
    return rows.select(F.col("source_row").alias("row_number"), "issue_code", "source_column")


@query(f"WITH {V.DICT} SELECT row_number, disposition FROM dict")
def dispositions_dict(spark, d):
    return _results(spark, d).select("row_number", "disposition")


@query(f"WITH {V.DICT} SELECT d.row_number, CASE WHEN broken THEN concat_ws('|', CASE WHEN expected_field = '' THEN 'BLANK_MANDATORY_COLUMN' END, CASE WHEN sub_domain = '' THEN 'BLANK_MANDATORY_COLUMN' END, CASE WHEN requirement_name = '' AND definition = '' THEN 'MISSING_DESCRIPTIVE_FIELD' END) ELSE 'TARGET_SPEC_VALIDATION_FAILED' END AS codes FROM dict d WHERE disposition = 'rejected'")
def rejected_rows(spark, d):
    errors = F.transform(F.filter("issues", lambda i: i["severity"] == "error"), lambda i: i["issue_code"])
    return _results(spark, d).where("disposition = 'rejected'").select("row_number", F.array_join(errors, "|").alias("codes"))


def _of_target(spark, d, **columns):
    return _results(spark, d).where(dictionary.NORMALIZED).select("row_number", *[c.alias(k) for k, c in columns.items()])


@query(f"WITH {V.DICT} SELECT row_number, target_row_id FROM dict WHERE {_OK}")
def target_row_ids(spark, d):
    return _of_target(spark, d, target_row_id=F.col("target.target_row_id"))


@query(f"WITH {V.DICT} SELECT row_number, cardinality FROM dict WHERE {_OK}")
def cardinality(spark, d):
    return _of_target(spark, d, cardinality=F.col("target.cardinality"))


@query(f"WITH {V.DICT} SELECT row_number, kind AS expected_type FROM dict WHERE {_OK}")
def expected_type(spark, d):
    return _of_target(spark, d, expected_type=F.col("target.expected_data_type"))


@query(f"WITH {V.DICT} SELECT row_number, coalesce(array_to_string(accepted, '|'), '') AS accepted_values FROM dict WHERE {_OK}")
def accepted_values(spark, d):
    return _of_target(spark, d, accepted_values=F.array_join("target.accepted_values", "|"))


@query(f"WITH {V.DICT} SELECT row_number, unit FROM dict WHERE {_OK}")
def units(spark, d):
    return _of_target(spark, d, unit=F.col("target.unit"))


@query(f"WITH {V.DICT} SELECT row_number, array_to_string(evidence, '|') AS evidence_types FROM dict WHERE {_OK}")
def evidence_types(spark, d):
    return _of_target(spark, d, evidence_types=F.array_join("target.likely_evidence_types", "|"))


@query(f"WITH {V.DICT} SELECT row_number, requirement_text FROM dict WHERE {_OK}")
def requirement_text(spark, d):
    return _of_target(spark, d, requirement_text=F.col("target.requirement_text"))


@query(f"WITH {V.DICT} SELECT row_number, concat_ws('|', 'requirement_name=' || raw_name, 'field_label=' || raw_label, 'example=' || example) AS metadata FROM dict WHERE {_OK}")
def metadata_map(spark, d):
    pairs = F.transform(F.map_entries("target.metadata"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return _of_target(spark, d, metadata=F.array_join(pairs, "|"))


@query(f"WITH {V.DICT} SELECT row_number, array_to_string(warned, '|') AS warnings FROM dict WHERE {_OK}")
def row_warnings(spark, d):
    return _of_target(spark, d, warnings=F.array_join("target.provenance.normalization_warnings", "|"))


@query(f"""WITH {V.DICT}, ok AS (SELECT * FROM dict WHERE {_OK}) SELECT count(*) AS physical_rows, count(*) FILTER (blank) AS blank_rows, count(*) FILTER (NOT blank) AS candidate_rows, count(*) FILTER ({_OK}) AS normalized_rows,
  count(*) FILTER (disposition = 'normalized_with_warnings') AS rows_with_warnings, count(*) FILTER (disposition = 'rejected') AS rejected_rows, count(DISTINCT target_row_id) FILTER ({_OK}) AS unique_ids,
  (SELECT count(*) FROM (SELECT target_row_id FROM ok GROUP BY 1 HAVING count(*) > 1)) AS duplicate_ids, {_bars("SELECT sub_domain AS k, count(*) AS n FROM ok GROUP BY 1")} AS counts_by_sub_domain,
  {_bars("SELECT kind AS k, count(*) AS n FROM ok GROUP BY 1")} AS counts_by_expected_type, {_bars("SELECT k, count(*) AS n FROM (SELECT unnest(evidence) AS k FROM ok) GROUP BY 1")} AS counts_by_likely_evidence_type,
  'Notes2' AS unmapped_columns, 'sub_domain' AS ambiguous_mappings FROM dict""")
def dict_summary(spark, d):
    mapping = replace(_MAPPING, unused=["Notes2"], ambiguous=["sub_domain"])
    lists = {c: F.array_join(c, "|") for c in ("unmapped_columns", "ambiguous_mappings")}
    return dictionary.summary(_results(spark, d), mapping).withColumns(_as_text("counts_by_sub_domain", "counts_by_expected_type", "counts_by_likely_evidence_type") | lists)


@query(f"WITH {V.DICT} SELECT sub_domain, count(*) AS n FROM dict WHERE {_OK} GROUP BY sub_domain")
def counts_by_subdomain(spark, d):
    return dictionary.histogram(_results(spark, d).where(dictionary.NORMALIZED), "target.sub_domain", "sub_domain")


@query(f"WITH {V.DICT} SELECT kind AS expected_type, count(*) AS n FROM dict WHERE {_OK} GROUP BY kind")
def counts_by_type(spark, d):
    return dictionary.histogram(_results(spark, d).where(dictionary.NORMALIZED), "target.expected_data_type", "expected_type")


@query(f"WITH {V.DICT} SELECT e AS evidence_type, count(*) AS n FROM (SELECT unnest(evidence) AS e FROM dict WHERE {_OK}) GROUP BY e")
def counts_by_evidence(spark, d):
    return dictionary.evidence_histogram(_results(spark, d))


_DOUBLED = "SELECT * FROM dict UNION ALL SELECT * FROM dict WHERE row_number % 10 = 0"


@query(f"WITH {V.DICT}, twice AS ({_DOUBLED}) SELECT target_row_id AS raw_value, string_agg(CAST(row_number AS VARCHAR), '|') AS \"rows\" FROM twice WHERE {_OK} GROUP BY target_row_id HAVING count(*) > 1")
def duplicate_target_ids(spark, d):
    rows = _results(spark, d)
    found = dictionary.duplicate_findings(rows.unionByName(rows.where("row_number % 10 = 0")))
    return found.where("issue_code = 'DUPLICATE_TARGET_ID'").select("raw_value", F.array_join("rows", "|").alias("rows"))


@query(f"WITH {V.DICT}, twice AS ({_DOUBLED}) SELECT CAST(row_number AS VARCHAR) AS raw_value, count(*) AS n FROM twice GROUP BY row_number HAVING count(*) > 1")
def duplicate_rows(spark, d):
    rows = _results(spark, d)
    found = dictionary.duplicate_findings(rows.unionByName(rows.where("row_number % 10 = 0")))
    return found.where("issue_code = 'DUPLICATE_PHYSICAL_ROW'").select("raw_value", F.size("rows").cast("bigint").alias("n"))


# Column binding: each order is a dictionary, its lines are the headers of its columns


_CHOICES = ("Field Name", "sub_domain", "Term  Name", "Sub-Domain", "Field Label", "Extra", "NOTES", "Data requirement ID", "Field_Name", " ", "Data Requirement id")
_FIELDS = [(f, i, dictionary.header_key(a)) for f, rule in dictionary.TEMPLATE["columns"].items() for i, a in enumerate(rule["aliases"])]
_REQUIRED = [(c, dictionary.header_key(c)) for c in dictionary.TEMPLATE["required_source_columns"]]
_values = lambda rows: ", ".join("(" + ", ".join(str(x) if isinstance(x, int) else f"'{x}'" for x in r) + ")" for r in rows)
_BOUND = f"""line AS (SELECT l_orderkey AS dictionary, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount) AS pos, {V._pick_sql(_CHOICES, "l_partkey + l_suppkey")} AS header FROM lineitem),
keyed AS (SELECT *, trim(regexp_replace(replace(lower(trim(header)), '_', ' '), '{_WS}', ' ', 'g')) AS key FROM line),
last AS (SELECT dictionary, key, max_by(header, pos) AS header FROM keyed GROUP BY dictionary, key),
alias(field, place, key) AS (VALUES {_values(_FIELDS)}), required(source_column, key) AS (VALUES {_values(_REQUIRED)}),
found AS (SELECT dictionary, field, min_by(header, place) AS source_column, count(DISTINCT header) > 1 AS ambiguous FROM last JOIN alias USING (key) GROUP BY dictionary, field)"""


def _bound(spark, d):
    t = V.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount")
    order = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount")
    headers = t.select(F.col("l_orderkey").alias("dictionary"), F.row_number().over(order).alias("pos"), V._pick(_CHOICES, F.col("l_partkey") + F.col("l_suppkey")).alias("header"))
    return dictionary.bind_headers(headers, dictionary.TEMPLATE)


@query(f"WITH {_BOUND} SELECT dictionary, field, source_column FROM found")
def column_map(spark, d):
    return _bound(spark, d)["bound"].select("dictionary", "field", "source_column")


@query(f"WITH {_BOUND} SELECT dictionary, header AS source_column, count(*) AS n FROM line WHERE (dictionary, header) NOT IN (SELECT dictionary, source_column FROM found) GROUP BY 1, 2")
def unused_columns(spark, d):
    return _bound(spark, d)["unused"].groupBy("dictionary", F.col("header").alias("source_column")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_BOUND} SELECT dictionary, field FROM found WHERE ambiguous")
def ambiguous_mappings(spark, d):
    return _bound(spark, d)["bound"].where("ambiguous").select("dictionary", "field")


@query(f"WITH {_BOUND} SELECT dictionary, source_column FROM (SELECT DISTINCT dictionary FROM line), required r WHERE NOT EXISTS (SELECT 1 FROM last WHERE last.dictionary = line.dictionary AND last.key = r.key)".replace("FROM (SELECT DISTINCT dictionary FROM line), required r", "FROM (SELECT DISTINCT dictionary FROM line) line, required r"))
def missing_required(spark, d):
    return _bound(spark, d)["missing"]


# Archive members

_LIMITS = members.ArchiveLimits(**V.MEMBER_LIMITS)
_KEY = ["archive", "idx"]


def _checked(spark, d):
    return members.check_members(V.members(spark, d), _LIMITS)


@query(f"WITH RECURSIVE {V.MEMBERS} SELECT archive, idx, array_to_string(issues, '|') AS issues FROM entry")
def member_checks(spark, d):
    return _checked(spark, d).select(*_KEY, F.array_join("issues", "|").alias("issues"))


@query(f"WITH RECURSIVE {V.MEMBERS} SELECT archive, idx, status FROM entry")
def member_status(spark, d):
    return _checked(spark, d).select(*_KEY, "status")


@query(f"WITH RECURSIVE {V.MEMBERS}, n AS (SELECT archive, count(*) AS entries FROM entry0 GROUP BY archive) SELECT e.archive, count(*) AS member_count, count(*) FILTER (status = 'registered') AS extracted_count, count(*) FILTER (status = 'rejected') AS rejected_count, count(*) FILTER (status = 'ignored') AS ignored_count, CAST(coalesce(sum(uncompressed_size) FILTER (status = 'registered'), 0) AS BIGINT) AS total_uncompressed_bytes, entries > 6 AS over_member_limit FROM entry e JOIN n ON e.archive = n.archive GROUP BY e.archive, entries")
def archive_summary(spark, d):
    total = V.members(spark, d).groupBy("archive").agg(F.count(F.lit(1)).alias("entries"))
    return members.archive_summaries(_checked(spark, d), total, _LIMITS)


@query(f"WITH {V.MEMBERS.split(',' + chr(10) + 'entry1')[0]} SELECT archive, count(*) AS n FROM entry0 GROUP BY archive HAVING count(*) > 6")
def member_limit(spark, d):
    return V.members(spark, d).groupBy("archive").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > _LIMITS.max_member_count)


@query(f"WITH RECURSIVE {V.MEMBERS} SELECT archive, idx FROM entry WHERE list_contains(issues, 'ARCHIVE_UNCOMPRESSED_LIMIT')")
def greedy_bytes(spark, d):
    return _checked(spark, d).where(F.array_contains("issues", "ARCHIVE_UNCOMPRESSED_LIMIT")).select(*_KEY)


@query(f"WITH RECURSIVE {V.MEMBERS} SELECT archive, idx FROM entry WHERE again")
def duplicate_members(spark, d):
    return _checked(spark, d).where(F.array_contains("issues", "ARCHIVE_DUPLICATE_MEMBER")).select(*_KEY)


@query(f"WITH RECURSIVE {V.MEMBERS} SELECT i AS issue_code, count(*) AS n FROM (SELECT unnest(issues) AS i FROM entry) GROUP BY i")
def warnings_by_code(spark, d):
    return members.warnings_by_code(_checked(spark, d))


@query(f"WITH RECURSIVE {V.MEMBERS}, {V.PACK}, {V.DICT} SELECT 'member' AS origin, i AS issue_code, count(*) AS n FROM (SELECT unnest(issues) AS i FROM entry) GROUP BY i UNION ALL SELECT 'file', 'UNSUPPORTED_FILE_TYPE', count(*) FROM pack WHERE NOT {_IGNORED} AND doc_id % 17 = 0 UNION ALL SELECT 'dictionary', i, count(*) FROM (SELECT unnest(warned) AS i FROM dict WHERE NOT blank AND NOT broken) GROUP BY i")
def issues_union(spark, d):
    member = members.warnings_by_code(_checked(spark, d)).select(F.lit("member").alias("origin"), "issue_code", "n")
    file = unsupported_files(spark, d).agg(F.count(F.lit(1)).alias("n")).select(F.lit("file").alias("origin"), F.lit("UNSUPPORTED_FILE_TYPE").alias("issue_code"), "n")
    rows = dictionary.issue_rows(_results(spark, d)).where("severity = 'warning'").groupBy("issue_code").agg(F.count(F.lit(1)).alias("n"))
    return member.unionByName(file).unionByName(rows.select(F.lit("dictionary").alias("origin"), "issue_code", "n"))


@query("SELECT 's' || s_suppkey AS id, r_name || '.zip!/' || n_name || '.zip!/' || s_name AS logical_path FROM region JOIN nation ON n_regionkey = r_regionkey JOIN supplier ON s_nationkey = n_nationkey")
def nested_logical_paths(spark, d):
    """Paths of members of nested archives, one level of containers at a time."""
    inside = lambda parent, name: F.concat_ws("!/", parent, name)
    root = V.table(spark, d, "region").select("r_regionkey", F.concat("r_name", F.lit(".zip")).alias("path"))
    first = V.table(spark, d, "nation").join(root, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", inside(F.col("path"), F.concat("n_name", F.lit(".zip"))).alias("path"))
    second = V.table(spark, d, "supplier").join(first, F.col("s_nationkey") == F.col("n_nationkey"))
    return second.select(F.concat(F.lit("s"), "s_suppkey").alias("id"), inside(F.col("path"), F.col("s_name")).alias("logical_path"))


# Evidence tree


@query(f"WITH {V.NODES} SELECT node_id, parent_id FROM nodes n WHERE parent_id IS NOT NULL AND parent_id NOT IN (SELECT node_id FROM nodes)")
def index_orphans(spark, d):
    return contracts.orphans(V.nodes(spark, d))


@query(f"WITH {V.NODES}, twice AS (SELECT node_id FROM nodes UNION ALL SELECT node_id FROM nodes WHERE node_type = 'document') SELECT node_id, count(*) AS n FROM twice GROUP BY node_id HAVING count(*) > 1")
def index_unique(spark, d):
    n = V.nodes(spark, d).select("node_id", "node_type")
    return contracts.repeated(n.unionByName(n.where("node_type = 'document'")), "node_id")


@query(f"WITH RECURSIVE {V.NODES}, p(node_id, path, depth) AS (SELECT node_id, node_id, 0 FROM nodes WHERE parent_id IS NULL UNION ALL SELECT n.node_id, p.path || '/' || n.node_id, p.depth + 1 FROM nodes n JOIN p ON n.parent_id = p.node_id) SELECT * FROM p")
def index_paths(spark, d):
    return contracts.node_paths(V.nodes(spark, d))


@query(f"WITH RECURSIVE {V.CHAINS}, p(node_id, path, depth) AS (SELECT node_id, node_id, 0 FROM chain WHERE parent_id IS NULL UNION ALL SELECT n.node_id, p.path || '/' || n.node_id, p.depth + 1 FROM chain n JOIN p ON n.parent_id = p.node_id) SELECT node_id, sha256(path) AS path_hash, depth FROM p")
def chain_paths(spark, d):
    """Paths of up to a hundred nodes; chains that begin with a cycle have none."""
    return contracts.node_paths(V.chains(spark, d)).select("node_id", F.sha2("path", 256).alias("path_hash"), "depth")


@query(f"WITH RECURSIVE {V.CHAINS}, r(node_id, up) AS (SELECT node_id, parent_id FROM chain WHERE parent_id IS NOT NULL UNION SELECT r.node_id, n.parent_id FROM r JOIN chain n ON r.up = n.node_id WHERE n.parent_id IS NOT NULL) SELECT node_id FROM r WHERE node_id = up")
def chain_cycles(spark, d):
    return contracts.cycles(V.chains(spark, d))


# Telemetry


@query(f"WITH {V.CALLS} SELECT model_name, CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens, CAST(sum(cached_tokens) AS BIGINT) AS cached_tokens, CAST(sum(input_tokens + output_tokens) AS BIGINT) AS total_tokens, CAST(sum(estimated_cost) AS DOUBLE) AS estimated_cost FROM calls GROUP BY model_name")
def telemetry_totals(spark, d):
    return contracts.telemetry_totals(V.calls(spark, d), "model_name").withColumn("estimated_cost", F.col("estimated_cost").cast("double"))


@query(f"WITH {V.CALLS} SELECT user_id, CASE WHEN count(*) FILTER (input_tokens % 5 = 0) > 0 THEN round(CAST(sum(estimated_cost) AS DOUBLE) / count(*) FILTER (input_tokens % 5 = 0), 3) END AS cost FROM calls GROUP BY user_id")
def cost_per_accepted(spark, d):
    t = V.calls(spark, d).groupBy("user_id").agg(F.sum("estimated_cost").alias("c"), F.count_if(F.col("input_tokens") % 5 == 0).alias("accepted"))
    return t.select("user_id", F.round(contracts.cost_per_accepted(F.col("c"), F.col("accepted")).cast("double"), 3).alias("cost"))


@query("SELECT event_type AS stage, CAST(sum(CAST(floor(coalesce(value, 0) * 100) AS BIGINT)) AS BIGINT) AS ticks, count(*) AS n FROM events GROUP BY event_type")
def stage_times(spark, d):
    t = V.table(spark, d, "events").select(F.col("event_type").alias("stage"), F.floor(F.coalesce("value", F.lit(0.0)) * 100).alias("duration_ms"))
    return timings.stage_totals(t).withColumnRenamed("duration_ms", "ticks")


# Expectations


@query(f"WITH {V.PACK}, {_LABEL}, x AS (SELECT source_id, CASE WHEN doc_id % 7 = 0 THEN confidence + 0.3 WHEN doc_id % 11 = 0 THEN NULL ELSE confidence END AS v FROM c) SELECT source_id AS \"key\", 'confidence' AS \"check\" FROM x WHERE v IS NULL OR v < 0 OR v > 1")
def confidence_violations(spark, d):
    pack = V.pack(spark, d)
    c = classify.classify_sources(pack).select(F.col("subject_id").alias("source_id"), "confidence").join(pack.select("source_id", "doc_id"), "source_id")
    v = F.when(F.col("doc_id") % 7 == 0, F.col("confidence") + 0.3).when(F.col("doc_id") % 11 == 0, None).otherwise(F.col("confidence"))
    return contracts.violations(c, "source_id", {"confidence": contracts.between_0_and_1(v)})


@query("SELECT conv_id || ':' || turn AS \"key\", 'range' AS \"check\" FROM conversations WHERE NOT (turn >= 1 AND conv_id % 9 >= turn)")
def range_violations(spark, d):
    t = V.table(spark, d, "conversations").select(F.concat("conv_id", F.lit(":"), "turn").alias("id"), "conv_id", "turn")
    return contracts.violations(t, "id", {"range": contracts.sound_range(F.col("turn"), F.col("conv_id") % 9)})


@query(f"SELECT doc_id AS \"key\", 'text' AS \"check\" FROM documents WHERE coalesce(trim(regexp_replace(CASE WHEN doc_id % 20 = 0 THEN ' ' || chr(9) ELSE text END, '{_WS}', ' ', 'g')), '') = ''")
def blank_text_violations(spark, d):
    t = V.table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 20 == 0, " \t").otherwise(F.col("text")).alias("text"))
    return contracts.violations(t, "doc_id", {"text": contracts.not_blank(F.col("text"))})


@query("SELECT vec_id AS \"key\", 'box' AS \"check\" FROM embeddings WHERE NOT (label % 5 >= 1 AND vec_id % 3 >= 1)")
def box_violations(spark, d):
    t = V.table(spark, d, "embeddings").select("vec_id", "label")
    zero = F.lit(0)
    return contracts.violations(t, "vec_id", {"box": contracts.sound_box(zero, zero, F.col("label") % 5, F.col("vec_id") % 3)})


@query("SELECT o_orderstatus AS status, count(*) AS n FROM orders WHERE o_orderstatus NOT IN ('accepted_exact', 'review_required') GROUP BY 1")
def domain_violations(spark, d):
    t = V.table(spark, d, "orders").select(F.col("o_orderstatus").alias("status"))
    return dictionary.histogram(t.where(~contracts.in_domain(F.col("status"), "validation_status")), "status", "status")


@query(f"""WITH {V.PACK}, s AS (SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN ' ' ELSE source_id END AS source_id, CASE WHEN doc_id % 17 = 0 THEN 'tar' ELSE file_type END AS file_type, CASE WHEN doc_id % 19 = 0 THEN -1 ELSE size_bytes END AS size_bytes FROM pack)
SELECT doc_id AS "key", unnest((CASE WHEN trim(source_id) = '' THEN ['source_id'] ELSE [] END) || (CASE WHEN file_type = 'tar' THEN ['file_type'] ELSE [] END) || (CASE WHEN size_bytes < 0 THEN ['size_bytes'] ELSE [] END)) AS "check" FROM s""")
def source_record_violations(spark, d):
    i = F.col("doc_id")
    rows = V.pack(spark, d).withColumns({"source_id": F.when(i % 13 == 0, " ").otherwise(F.col("source_id")), "file_type": F.when(i % 17 == 0, "tar").otherwise(F.col("file_type")), "size_bytes": F.when(i % 19 == 0, -1).otherwise(F.col("size_bytes"))})
    rows = rows.withColumns({"original_path": F.col("logical_path"), "extraction_status": F.lit("registered"), "page_count": F.lit(None).cast("int"), "archive_depth": F.lit(0)})
    return contracts.record_violations(rows, "doc_id", "source")


@query(f"WITH {V.DICT} SELECT row_number AS \"key\", 'sub_domain' AS \"check\" FROM dict WHERE {_OK} AND row_number % 10 = 0 UNION ALL SELECT row_number, 'accepted_values' FROM dict WHERE {_OK} AND row_number % 11 = 0 AND len(accepted) > 0")
def target_record_violations(spark, d):
    rows = _results(spark, d).where(dictionary.NORMALIZED).select("row_number", "target.*")
    twice = F.concat("accepted_values", F.transform("accepted_values", F.upper))
    rows = rows.withColumns({"sub_domain": F.when(F.col("row_number") % 10 == 0, "").otherwise(F.col("sub_domain")), "accepted_values": F.when(F.col("row_number") % 11 == 0, twice).otherwise(F.col("accepted_values"))})
    return contracts.record_violations(rows, "row_number", "target")


@query(f"WITH {V.CALLS} SELECT model_name AS strategy, count(*) AS operations, CAST(sum(input_tokens) AS BIGINT) AS candidate_count, CAST(sum(output_tokens) AS BIGINT) AS selected_count FROM calls GROUP BY model_name")
def retrieval_totals(spark, d):
    rows = V.calls(spark, d).select(F.col("model_name").alias("strategy"), F.col("input_tokens").alias("candidate_count"), F.col("output_tokens").alias("selected_count"))
    return contracts.retrieval_totals(rows, "strategy")


# Bundles and validations


#: 512 terms, in order.
_MANY = ["".join(x) for x in itertools.product("aeinorst", repeat=3)]


@query(f"""WITH t AS (SELECT unnest({_MANY}) AS term) SELECT doc_id, count(term) AS n_terms, coalesce(string_agg(term, '|' ORDER BY term), '') AS terms FROM documents LEFT JOIN t ON contains(replace(lower(text), 'ß', 'ss'), term) GROUP BY doc_id""")
def many_terms(spark, d):
    found = V.table(spark, d, "documents").select("doc_id", F.coalesce(terms.terms_in(F.col("text"), _MANY), F.array().cast("array<string>")).alias("f"))
    return found.select("doc_id", F.size("f").cast("bigint").alias("n_terms"), F.array_join("f", "|").alias("terms"))


_TERMS = ("tion", "hand ", "Thou", "was", "that er")
_BUNDLE = 3


@query(f"""WITH u AS (SELECT CAST(conv_id AS VARCHAR) AS target_row_id, turn, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS position FROM conversations),
  p AS (SELECT *, (position - 1) // {_BUNDLE} AS part, count(*) OVER (PARTITION BY target_row_id, (position - 1) // {_BUNDLE}) AS units FROM u),
  h AS (SELECT *, list_filter(string_split(text, chr(10)), lambda l: contains(lower(l), term)) AS lines FROM p, (SELECT unnest({[t.lower() for t in _TERMS]}) AS term) WHERE contains(lower(text), term))
  SELECT target_row_id, term AS requirement_id, first(lines[1] ORDER BY position) AS candidate_value, CAST(part AS VARCHAR) AS page_or_sheet, 'mentioned_terms' AS capability_id, count(*) / max(units) AS confidence,
    string_agg(CAST(position AS VARCHAR), ',' ORDER BY position) AS units_cited, CASE WHEN count(*) / max(units) < 0.5 THEN 'confidence < 0.5D' ELSE '' END AS rejected_by FROM h GROUP BY target_row_id, term, part""")
def capability_candidates(spark, d):
    units = V.table(spark, d, "conversations").withColumn("target_row_id", F.col("conv_id").cast("string"))
    found, _ = capabilities.bounded_bundles(units, "target_row_id", ["turn", "role", "text"], ["text"], _BUNDLE)
    ability = capabilities.MentionedTerms(_TERMS, least=0.5)
    got = ability.judged(ability.extract(found))
    return got.select("target_row_id", "requirement_id", "candidate_value", "page_or_sheet", "capability_id", "confidence", F.col("reasoning_summary").alias("units_cited"), F.array_join("rejected_by", "|").alias("rejected_by"))


@query(f"""WITH u AS (SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1) // 2 AS part, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS position,
    turn, length(coalesce(text, '')) AS chars FROM conversations) SELECT conv_id, part, string_agg(position || ':' || turn || ':' || chars, '|' ORDER BY position) AS units, count(*) AS n_units FROM u GROUP BY conv_id, part""")
def bounded_bundles(spark, d):
    found, _ = capabilities.bounded_bundles(V.table(spark, d, "conversations"), "conv_id", ["turn", "role", "text"], ["turn", "text"], 2)
    told = F.array_join(F.transform("units", lambda u: F.concat_ws(":", u["position"], u["turn"], F.length(F.coalesce(u["text"], F.lit(""))))), "|")
    return found.select("conv_id", "part", told.alias("units"), "n_units")


@query("SELECT conv_id, string_agg(turn || ':' || coalesce(role, '') || ':' || length(coalesce(text, '')), '|' ORDER BY turn, role, length(coalesce(text, ''))) AS units, count(*) AS n_units FROM conversations GROUP BY conv_id")
def bundle_assembly(spark, d):
    t = V.table(spark, d, "conversations").select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.length(F.coalesce("text", F.lit(""))).alias("chars"))
    b = contracts.bundles(t, "conv_id", "turn", ["role", "chars"])
    return b.select("conv_id", F.array_join(F.transform("units", lambda u: F.concat_ws(":", u["turn"], u["role"], u["chars"])), "|").alias("units"), "n_units")


_STATUS = ("accepted_exact", "accepted_normalized", "rejected_unit", "review_required")


@query("WITH f AS (SELECT doc_id AS target_row_id, CASE (quality + doc_id) % 4 WHEN 0 THEN 'unit' WHEN 1 THEN 'conflict' WHEN 2 THEN 'data_type' ELSE 'duplicate' END AS c, "
    + V._pick_sql(_STATUS, "toxic + doc_id") + " AS s FROM labels) SELECT target_row_id, " + ", ".join(f"min(CASE WHEN c = '{c}' THEN s END) AS {c}_result" for c in contracts.VALIDATION_CHECKS) + " FROM f GROUP BY target_row_id")
def validation_pivot(spark, d):
    t = V.table(spark, d, "labels").select(
        F.col("doc_id").alias("target_row_id"),
        V._pick(("unit", "conflict", "data_type", "duplicate"), F.col("quality") + F.col("doc_id")).alias("check"),
        V._pick(_STATUS, F.col("toxic") + F.col("doc_id")).alias("status"),
    )
    return contracts.validation_wide(t)


# Files: packs and dictionaries written from the tables, read and described by the engine


@contextlib.contextmanager
def _scratch(spark, kind):
    folder = scratch(spark, kind)
    try:
        yield folder
    finally:
        remove_dir(folder)


def _kept(df):
    """A result that no longer reads the files that it was made of."""
    return written(df, scratch(df.sparkSession, "result"))


def _ingested(spark, d, write, take, **how):
    with _scratch(spark, "pack") as folder:
        write(spark, d, folder)
        result = pack_plan.ingest_source_pack(spark, folder, **how)
        out = _kept(take(result))
        result.release()
    return out


_REGISTERED = f"""registered AS (SELECT *, CASE WHEN file_type = 'csv' THEN 'spreadsheet' WHEN file_type = 'zip' THEN 'archive' ELSE 'drawing set' END AS label, CASE WHEN file_type = 'pdf' THEN 1 + len(regexp_extract_all(substr(content, 21), '/Type ?/Page')) END AS pages FROM file WHERE NOT ignored)"""


@query(f"WITH {X.DOCUMENT_FILES}, {_REGISTERED} SELECT source_id, logical_path, file_type, extension, file_hash, size_bytes, size_bytes AS bytes_read, CAST(pages AS INT) AS page_count, label AS classification, 'sha256:' || file_hash AS content_identity, 0 AS archive_depth FROM registered")
def files_registered(spark, d):
    names = ["source_id", "logical_path", "file_type", "extension", "file_hash", "size_bytes", "bytes_read", "page_count", "classification", "content_identity", "archive_depth"]
    return _ingested(spark, d, X.write_document_pack, lambda r: r.registry.select(*names), limits=members.ArchiveLimits(max_depth=0))


@query(f"WITH {X.DOCUMENT_FILES} SELECT logical_path AS relative_path, split_part(logical_path, '/', 2) AS file_name, extension, file_type AS detected_type, size_bytes, CASE WHEN ignored THEN 'ignored' ELSE 'registered' END AS disposition, ignored AS unhashed FROM file")
def files_discovered(spark, d):
    """Ignored files are listed, but neither hashed nor read to their end."""
    names = ["relative_path", "file_name", "extension", "detected_type", "size_bytes", "disposition", F.col("sha256").isNull().alias("unhashed")]
    return _ingested(spark, d, X.write_document_pack, lambda r: r.discovered.select(*names), limits=members.ArchiveLimits(max_depth=0))


@query(f"WITH {X.DOCUMENT_FILES} SELECT extension, count(*) AS n FROM file GROUP BY extension")
def inspected_extensions(spark, d):
    with _scratch(spark, "pack") as folder:
        X.write_document_pack(spark, d, folder)
        return _kept(pack_plan.inspect_source_pack(spark, folder)["extensions"])


@query(f"WITH {X.DOCUMENT_FILES}, {_REGISTERED} SELECT source_id, file_hash AS content_hash, logical_path, file_type, CAST(size_bytes AS VARCHAR) AS size_bytes, label AS classification FROM registered")
def registry_artifact(spark, d):
    """The registry as it was written to CSV and read back."""

    def take(result):
        paths = sinks.write_pack(result, result.root_path + "-out")
        return spark.read.csv(paths["source_registry_csv"], header=True, escape='"', multiLine=True).select("source_id", "content_hash", "logical_path", "file_type", "size_bytes", "classification")

    return _ingested(spark, d, X.write_document_pack, take, limits=members.ArchiveLimits(max_depth=0))


@query(f"WITH {X.DOCUMENT_FILES}, {_REGISTERED} SELECT logical_path AS relative_path, size_bytes AS file_size, file_type AS detected_type, CASE WHEN ignored THEN 'ignored' WHEN file_type = 'csv' OR file_type = 'pdf' THEN 'told' ELSE 'registered' END AS status, true AS timed FROM file")
def file_times(spark, d):
    """Each file's times: none is negative, the total is their sum, and files that were hashed have some."""
    parts = [F.col(c) for c in ("file_type_detection_ms", "hashing_duration_ms", "metadata_inspection_ms", "classification_ms", "archive_duration_ms")]
    total = sum(parts, F.lit(0.0))
    sound = F.forall(F.array(*parts), lambda x: x >= 0) & (F.abs(total - F.col("total_duration_ms")) < 1e-6) & (total > 0)
    status = F.when(F.col("detected_type").isin("csv", "pdf") & (F.col("status") != "ignored"), "told").otherwise(F.col("status"))
    return _ingested(spark, d, X.write_document_pack, lambda r: r.file_timings.select("relative_path", "file_size", "detected_type", status.alias("status"), sound.alias("timed")), limits=members.ArchiveLimits(max_depth=0))


@query(f"WITH {X.ARCHIVE_MEMBERS} SELECT archive_path || '!/' || path AS logical_path, path AS archive_member_path, size AS size_bytes, sha256(content) AS file_hash, CASE WHEN a = 0 THEN 2 ELSE 1 END AS archive_depth FROM member WHERE good UNION ALL SELECT 'a0.zip!/in/0.zip', 'in/0.zip', size, NULL, 1 FROM inner_zip")
def members_registered(spark, d):
    """Members of archives, and of one within another, which is a member, too."""
    file_hash = F.when(F.col("file_type") != "zip", F.col("file_hash")).alias("file_hash")
    take = lambda r: r.registry.where("archive_depth > 0").select("logical_path", "archive_member_path", "size_bytes", file_hash, "archive_depth")
    return _ingested(spark, d, X.write_archive_pack, take)


@query(f"WITH {X.ARCHIVE_MEMBERS} SELECT archive_path, count(*) AS member_count, count(*) FILTER (good) AS extracted_count, count(*) FILTER (NOT good) AS rejected_count, 0 AS ignored_count, CAST(coalesce(sum(size) FILTER (good), 0) AS BIGINT) AS total_uncompressed_bytes FROM member GROUP BY archive_path UNION ALL SELECT 'a0.zip', 1, 1, 0, 0, size FROM inner_zip")
def archive_counters(spark, d):
    names = ["archive_path", "member_count", "extracted_count", "rejected_count", "ignored_count", "total_uncompressed_bytes"]
    return _ingested(spark, d, X.write_archive_pack, lambda r: r.archives.select(*names))


@query(f"WITH {X.ARCHIVE_MEMBERS} SELECT 'ARCHIVE_ABSOLUTE_PATH' AS issue_code, 'error' AS severity, archive_path AS source_path, path AS archive_member_path FROM member WHERE NOT good")
def issues_artifact(spark, d):
    """The issues as they were written to CSV and read back."""

    def take(result):
        paths = sinks.write_pack(result, result.root_path + "-out")
        return spark.read.csv(paths["ingestion_issues_csv"], header=True, escape='"').select("issue_code", "severity", "source_path", "archive_member_path")

    return _ingested(spark, d, X.write_archive_pack, take)


def _dictionary_file(spark, d, write, name, take):
    with _scratch(spark, "dictionary") as folder:
        write(f"{folder}/{name}")
        result = dictionaries.ingest_dictionary(spark, f"{folder}/{name}", range_bytes=X.RANGE_BYTES)
        out = _kept(take(result, folder))
        result.release()
    return out


def _dict_of(source: str) -> str:
    """The view's rows as those of a file, which begin in its second row."""
    return V.DICT.replace("extraction_template|part|", f"extraction_template|{source}|").replace("CAST(p_partkey + 1 AS INT)", "CAST(p_partkey + 2 AS INT)")


_SPEC = "target_row_id, rid AS requirement_id, sub_domain, expected_field, kind AS expected_data_type, cardinality, unit, row_number AS source_row"


@query(f"WITH {_dict_of('parts.csv')} SELECT {_SPEC} FROM dict WHERE {_OK}")
def csv_dictionary_targets(spark, d):
    names = ["target_row_id", "requirement_id", "sub_domain", "expected_field", "expected_data_type", "cardinality", "unit", F.col("provenance.row_number").alias("source_row")]
    return _dictionary_file(spark, d, lambda p: X.write_dictionary_csv(spark, d, p), "parts.csv", lambda r, _: r.targets.select(*names))


@query(f"WITH {_dict_of('Parts')} SELECT {_SPEC} FROM dict WHERE {_OK}")
def xlsx_dictionary_targets(spark, d):
    names = ["target_row_id", "requirement_id", "sub_domain", "expected_field", "expected_data_type", "cardinality", "unit", F.col("provenance.row_number").alias("source_row")]
    return _dictionary_file(spark, d, lambda p: X.write_dictionary_xlsx(spark, d, p, "Parts"), "parts.xlsx", lambda r, _: r.targets.select(*names))


@query(f"WITH {_dict_of('Parts')} SELECT target_row_id, rid AS requirement_id, sub_domain, expected_field, CAST(row_number AS VARCHAR) AS source_row, array_to_string(evidence, '|') AS likely_evidence_types, nullif(array_to_string(warned, '|'), '') AS warning_codes FROM dict WHERE {_OK}")
def targets_artifact(spark, d):
    """The targets as they were written to CSV and read back."""

    def take(result, folder):
        paths = sinks.write_dictionary(result, f"{folder}/out")
        return spark.read.csv(paths["normalized_targets_csv"], header=True, escape='"').select("target_row_id", "requirement_id", "sub_domain", "expected_field", "source_row", "likely_evidence_types", "warning_codes")

    return _dictionary_file(spark, d, lambda p: X.write_dictionary_xlsx(spark, d, p, "Parts"), "parts.xlsx", take)


@query(f"WITH {V.DICT} SELECT i AS issue_code, count(*) AS n FROM (SELECT unnest(CASE WHEN blank THEN [] WHEN broken THEN (CASE WHEN expected_field = '' THEN ['BLANK_MANDATORY_COLUMN'] ELSE [] END) || (CASE WHEN sub_domain = '' THEN ['BLANK_MANDATORY_COLUMN'] ELSE [] END) || (CASE WHEN requirement_name = '' AND definition = '' THEN ['MISSING_DESCRIPTIVE_FIELD'] ELSE [] END) ELSE warned || (CASE WHEN clash THEN ['TARGET_SPEC_VALIDATION_FAILED'] ELSE [] END) END) AS i FROM dict) GROUP BY i")
def dictionary_issues_artifact(spark, d):
    def take(result, folder):
        paths = sinks.write_dictionary(result, f"{folder}/out")
        return dictionary.histogram(spark.read.csv(paths["validation_issues_csv"], header=True, escape='"').where("suggested_action IS NOT NULL"), "issue_code", "issue_code")

    return _dictionary_file(spark, d, lambda p: X.write_dictionary_csv(spark, d, p), "parts.csv", take)


@query(f"WITH {V.DICT} SELECT 'parts.csv' AS source_name, count(*) AS physical_rows, count(*) FILTER (blank) AS blank_rows FROM dict")
def inspected_dictionary(spark, d):
    with _scratch(spark, "dictionary") as folder:
        X.write_dictionary_csv(spark, d, f"{folder}/parts.csv")
        rows, raw, _, source = dictionaries.inspected_rows(spark, f"{folder}/parts.csv", range_bytes=X.RANGE_BYTES)
        out = _kept(dictionaries.sheet_counts(rows).select(F.lit(source).alias("source_name"), "*"))
        raw.unpersist()
    return out


@query(f"WITH {V.DICT} SELECT row_number, array_to_string(list_filter([CASE WHEN expected_field <> '' THEN 'Field Name' END, CASE WHEN sub_domain <> '' THEN 'Sub-Domain' END, CASE WHEN example IS NOT NULL THEN 'Example=' || example END], lambda x: x IS NOT NULL), '|') AS cells FROM dict WHERE {_OK}")
def raw_cells(spark, d):
    """Non-blank cells that a target remembers."""
    cells = F.col("target.provenance.raw_value_provenance")
    has = lambda c: F.when(F.try_element_at(cells, F.lit(c)).isNotNull(), F.lit(c))
    shown = F.array_compact(F.array(has("Field Name"), has("Sub-Domain"), F.concat(F.lit("Example="), F.try_element_at(cells, F.lit("Example")))))
    return _of_target(spark, d, cells=F.array_join(shown, "|"))
