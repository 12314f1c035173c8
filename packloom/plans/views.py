"""Deterministic views of the tables as packs, dictionaries, archive members, trees and model calls; each also as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from packloom.functions import ids

WORDS = ("Maintenance", "schedule", "Certificate", "commissioning", "Drawing", "specification", "supplier", "Manual", "notes")
EXTENSIONS = (".pdf", ".xlsx", ".csv", ".zip", ".png", ".docx", ".txt")
TYPES = ("pdf", "xlsx", "csv", "zip", "image", "zip", "text")
PREFIXES = ("", "", "~$", "", "")
#: So many documents have names of their own.
NAMES = 90
LABELS = ("Count", "Install Date", "Floor area", "Category", "Label", "Y / N flag", " \t ", "Update log")
DEFINITIONS = ("Number of doors", "ISO 8601 stamp", "Rated capacity kW", "yes/no", "Class of asset", "Notes on operating rating", None, "", "Free text")
GUIDANCE = ("e.g. Red, Green; Blue", "A / a", "See schedule and warranty list", None, "eg. one, two, two", "Rating in mm", "e.g. " + ", ".join(f"v{i}" for i in range(21)), "m2 plan; workbook", "", "E.g. x / y, x")
CARDINALITIES = ("Y", "no", None, "maybe", " Multiple ", "1", "FALSE")
MEMBER_PATHS = ("docs/", "inside\\manual.pdf", "../escape.txt", "/abs.txt", "nested/inner.zip", "a/b/c.txt", "x..y/ok.txt")
HEADERS = ("Field Name", "Term_Name ", " Sub-Domain", "FIELD  LABEL", "Notes", "", "Notes", "Example")


def _sql(v) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


def _pick(values: tuple, n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (F.pmod(n, F.lit(len(values))) + 1).cast("int"))


def _pick_sql(values: tuple, n: str) -> str:
    return f"([{', '.join(map(_sql, values))}])[1 + ({n}) % {len(values)}]"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def pack(spark: SparkSession, d: str) -> DataFrame:
    """Documents as registered sources."""
    t = table(spark, d, "documents").select("doc_id", "text", "lang", "source")
    i = F.pmod(F.col("doc_id"), F.lit(NAMES))  # names repeat, and some of them in one folder
    n = F.col("doc_id")
    name = F.concat(_pick(PREFIXES, F.floor(i / 3)), _pick(WORDS, i), F.lit("_"), i % 40, _pick(EXTENSIONS, i))
    rows = t.select(
        "doc_id",
        F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")), name).alias("logical_path"),
        name.alias("file_name"),
        _pick(TYPES, i).alias("file_type"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("file_hash"),
        F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("size_bytes"),
        F.when(n % 4 == 0, F.concat(F.lit("a"), n % 30)).alias("parent_archive_source_id"),
        F.when(n % 4 == 0, F.concat(F.lit("m"), n % 10)).alias("archive_member_path"),
    )
    return rows.withColumn("source_id", ids.source_id("file_hash", "logical_path", F.col("parent_archive_source_id"), F.concat(F.coalesce("archive_member_path", F.lit("")), F.lit("#"), n)))


_I = f"(doc_id % {NAMES})"
PACK_NAME = f"{_pick_sql(PREFIXES, f'{_I} // 3')} || {_pick_sql(WORDS, _I)} || '_' || ({_I} % 40) || {_pick_sql(EXTENSIONS, _I)}"
PACK = f"""pack0 AS (SELECT doc_id, coalesce(source, '') || '/' || coalesce(lang, '') || '/' || {PACK_NAME} AS logical_path, {PACK_NAME} AS file_name,
  {_pick_sql(TYPES, _I)} AS file_type, sha256(coalesce(text, '')) AS file_hash, strlen(coalesce(text, '')) AS size_bytes,
  CASE WHEN doc_id % 4 = 0 THEN 'a' || (doc_id % 30) END AS parent_archive_source_id, CASE WHEN doc_id % 4 = 0 THEN 'm' || (doc_id % 10) END AS archive_member_path FROM documents),
pack AS (SELECT *, 'src_' || substr(sha256(file_hash || '|' || logical_path || '|' || coalesce(parent_archive_source_id, '') || '|' || coalesce(archive_member_path, '') || '#' || doc_id), 1, 16) AS source_id FROM pack0)"""


DICTIONARY_COLUMNS = ("Field Name", "Data Requirement id", "Term Name", "Sub-Domain", "Field Label", "Business Definition", "Notes", "Multiple Records Possible (Y/N)", "Example")


def dictionary(spark: SparkSession, d: str) -> DataFrame:
    """Parts as rows of an extraction template: row_number and cells."""
    t = table(spark, d, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    i = F.col("p_partkey")
    blank = i % 50 == 0
    cells = {
        "Field Name": F.when(i % 37 != 0, F.col("p_name")),
        "Data Requirement id": F.when(i % 6 != 0, F.concat(F.lit("R"), i)),
        "Term Name": F.when(i % 5 != 0, F.col("p_brand")),
        "Sub-Domain": F.when(i % 41 != 0, F.col("p_type")),
        "Field Label": F.when(i % 11 != 0, _pick(LABELS, i)),
        "Business Definition": _pick(DEFINITIONS, i),
        "Notes": _pick(GUIDANCE, i),
        "Multiple Records Possible (Y/N)": _pick(CARDINALITIES, i),
        "Example": F.when(i % 3 == 0, F.concat(F.lit("ex "), i % 10)),
    }
    both = [x for k, v in cells.items() for x in (F.lit(k), F.when(~blank, v))]
    return t.select((i + 1).cast("int").alias("row_number"), F.create_map(*both).alias("cells"))


def _cell(expr: str) -> str:
    return f"CASE WHEN p_partkey % 50 <> 0 THEN {expr} END"


_BLANKS = "' ' || chr(9) || chr(10) || chr(13)"
#: Stripped fields, as the normaliser sees them.
DICT = f"""dict0 AS (SELECT CAST(p_partkey + 1 AS INT) AS row_number,
  {_cell("CASE WHEN p_partkey % 37 <> 0 THEN p_name END")} AS expected_field, {_cell("CASE WHEN p_partkey % 6 <> 0 THEN 'R' || p_partkey END")} AS requirement_id,
  {_cell("CASE WHEN p_partkey % 5 <> 0 THEN p_brand END")} AS requirement_name, {_cell("CASE WHEN p_partkey % 41 <> 0 THEN p_type END")} AS sub_domain,
  {_cell(f"CASE WHEN p_partkey % 11 <> 0 THEN {_pick_sql(LABELS, 'p_partkey')} END")} AS field_label, {_cell(_pick_sql(DEFINITIONS, 'p_partkey'))} AS definition,
  {_cell(_pick_sql(GUIDANCE, 'p_partkey'))} AS guidance, {_cell(_pick_sql(CARDINALITIES, 'p_partkey'))} AS card,
  {_cell("CASE WHEN p_partkey % 3 = 0 THEN 'ex ' || (p_partkey % 10) END")} AS example FROM part),
dict1 AS (SELECT row_number, {", ".join(f"trim(coalesce({c}, ''), {_BLANKS}) AS {c}" for c in ("expected_field", "requirement_id", "requirement_name", "sub_domain", "field_label", "definition", "guidance", "card"))}, field_label AS raw_label, requirement_name AS raw_name, example FROM dict0),
dict2 AS (SELECT *, lower(field_label || ' ' || definition || ' ' || guidance) AS hay, lower(guidance) AS low, lower(card) AS lcard,
  expected_field = '' AND requirement_id = '' AND requirement_name = '' AND sub_domain = '' AND field_label = '' AND definition = '' AND guidance = '' AND card = '' AND coalesce(example, '') = '' AS blank FROM dict1),
dict3 AS (SELECT *,
  CASE WHEN contains(hay, 'y / n') OR contains(hay, 'yes/no') OR contains(hay, 'yes / no') THEN 'boolean' WHEN contains(hay, 'iso 8601') OR contains(lower(field_label), 'date') THEN 'date'
    WHEN lower(field_label) = 'count' OR contains(hay, 'number of') THEN 'integer' WHEN regexp_matches(hay, 'area|height|width|length|capacity|rating') THEN 'decimal'
    WHEN regexp_matches(hay, 'e\\.g\\.|category|class') THEN 'enum' WHEN trim(hay) = '' THEN 'unknown' ELSE 'string' END AS kind,
  CASE WHEN lcard IN ('y', 'yes', 'true', '1', 'multiple') THEN 'multiple' WHEN lcard IN ('n', 'no', 'false', '0', 'single') THEN 'single' ELSE 'unknown' END AS cardinality,
  CASE WHEN contains(low, 'sqm') THEN 'sqm' WHEN contains(low, 'm2') THEN 'm2' WHEN contains(low, 'kw') THEN 'kW' WHEN contains(low, 'kva') THEN 'kVA' WHEN contains(low, 'kg') THEN 'kg' WHEN contains(low, 'mm') THEN 'mm' WHEN contains(low, 'm ') THEN 'm' END AS unit,
  CASE WHEN contains(low, 'e.g.') THEN substr(guidance, strpos(low, 'e.g.') + 4) WHEN contains(low, 'eg.') THEN substr(guidance, strpos(low, 'eg.') + 3) WHEN contains(low, 'e.g') THEN substr(guidance, strpos(low, 'e.g') + 3) WHEN contains(guidance, ' / ') THEN guidance END AS listing FROM dict2),
dict4 AS (SELECT row_number, part, min(k) AS k FROM (SELECT row_number, unnest(parts) AS part, unnest(range(len(parts))) AS k
  FROM (SELECT row_number, list_transform(regexp_split_to_array(listing, ' / |,|;'), lambda x: trim(x)) AS parts FROM dict3 WHERE listing IS NOT NULL)) WHERE part <> '' GROUP BY row_number, part),
dict5 AS (SELECT row_number, list(part ORDER BY k) AS listed, count(*) AS n_listed, count(DISTINCT lower(part)) AS n_lower FROM dict4 GROUP BY row_number),
dict6 AS (SELECT dict3.*, CASE WHEN n_listed <= 20 THEN listed END AS accepted, coalesce(n_listed, 0) AS n_listed, coalesce(n_listed <= 20 AND n_lower < n_listed, false) AS clash,
  expected_field = '' OR sub_domain = '' OR (requirement_name = '' AND definition = '') AS broken,
  (CASE WHEN contains(low, 'certificate') OR contains(low, 'warranty') THEN ['certificate'] ELSE [] END) || (CASE WHEN regexp_matches(low, 'schedule|matrix|list') THEN ['table'] ELSE [] END)
    || (CASE WHEN regexp_matches(low, 'drawing|plan|layout') THEN ['drawing'] ELSE [] END) || (CASE WHEN regexp_matches(low, 'spreadsheet|workbook|csv') THEN ['spreadsheet'] ELSE [] END) AS evidence0,
  (CASE WHEN requirement_id = '' THEN ['MISSING_REQUIREMENT_ID'] ELSE [] END) || (CASE WHEN lcard = '' THEN ['MISSING_CARDINALITY'] ELSE [] END) || (CASE WHEN lcard <> '' AND cardinality = 'unknown' THEN ['INVALID_CARDINALITY'] ELSE [] END)
    || (CASE WHEN kind = 'unknown' THEN ['UNSUPPORTED_EXPECTED_TYPE'] ELSE [] END) || (CASE WHEN coalesce(n_listed, 0) > 20 THEN ['MALFORMED_ACCEPTED_VALUES'] ELSE [] END) AS warned,
  CASE WHEN requirement_id = '' THEN 'row_' || dict3.row_number ELSE requirement_id END AS rid
  FROM dict3 LEFT JOIN dict5 ON dict3.row_number = dict5.row_number),
dict AS (SELECT *, CASE WHEN len(evidence0) = 0 THEN ['text'] ELSE evidence0 END AS evidence,
  CASE WHEN blank THEN 'ignored_blank' WHEN broken OR clash THEN 'rejected' WHEN len(warned) > 0 THEN 'normalized_with_warnings' ELSE 'normalized' END AS disposition,
  'trg_' || substr(sha256('extraction_template|part|' || row_number || '|' || rid || '|' || expected_field), 1, 16) AS target_row_id,
  coalesce(nullif(concat_ws(' - ', nullif(requirement_name, ''), nullif(field_label, ''), nullif(definition, '')), ''), 'Unspecified requirement') AS requirement_text FROM dict6)"""


def members(spark: SparkSession, d: str) -> DataFrame:
    """Line items as entries of archives, one archive an order."""
    t = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount")
    order = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount")
    path = _pick(MEMBER_PATHS, F.col("l_partkey"))
    return t.select(
        F.col("l_orderkey").alias("archive"),
        (F.row_number().over(order) - 1).alias("idx"),
        F.when(F.col("l_partkey") % 3 == 0, path).otherwise(F.concat(F.lit("f"), F.col("l_partkey"), F.lit(".txt"))).alias("member_path"),
        F.when(F.col("l_partkey") % 3 == 0, path.endswith("/")).otherwise(False).alias("is_dir"),
        (F.col("l_suppkey") % 10 == 0).alias("encrypted"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("compressed_size"),
        F.col("l_quantity").cast("bigint").alias("uncompressed_size"),
    )


#: The bounds under which the view's entries break every rule.
MEMBER_LIMITS = {"max_member_count": 6, "max_uncompressed_bytes": 60, "max_member_bytes": 45, "max_compression_ratio": 12.0}
_PATH = _pick_sql(MEMBER_PATHS, "l_partkey")
MEMBERS = f"""entry0 AS (SELECT l_orderkey AS archive, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount) - 1 AS INT) AS idx,
  replace(CASE WHEN l_partkey % 3 = 0 THEN {_PATH} ELSE 'f' || l_partkey || '.txt' END, chr(92), '/') AS member_path,
  CASE WHEN l_partkey % 3 = 0 THEN ends_with({_PATH}, '/') ELSE false END AS is_dir, l_suppkey % 10 = 0 AS encrypted,
  CAST(round(l_discount * 100) AS BIGINT) AS compressed_size, CAST(l_quantity AS BIGINT) AS uncompressed_size FROM lineitem),
entry1 AS (SELECT *, row_number() OVER (PARTITION BY archive, member_path ORDER BY idx) > 1 AS again, CASE WHEN compressed_size <> 0 THEN uncompressed_size / compressed_size ELSE uncompressed_size END AS ratio FROM entry0 WHERE idx < 6),
entry2 AS (SELECT *, (CASE WHEN starts_with(member_path, '/') THEN ['ARCHIVE_ABSOLUTE_PATH'] ELSE [] END) || (CASE WHEN list_contains(string_split(member_path, '/'), '..') THEN ['ARCHIVE_PATH_TRAVERSAL'] ELSE [] END)
  || (CASE WHEN again THEN ['ARCHIVE_DUPLICATE_MEMBER'] ELSE [] END) || (CASE WHEN encrypted THEN ['ARCHIVE_ENCRYPTED_MEMBER'] ELSE [] END)
  || (CASE WHEN uncompressed_size > 45 THEN ['ARCHIVE_MEMBER_SIZE_LIMIT'] ELSE [] END) || (CASE WHEN ratio > 12 THEN ['ARCHIVE_COMPRESSION_RATIO_LIMIT'] ELSE [] END) AS codes FROM entry1),
fold(archive, idx, total, over) AS (SELECT archive, -1, CAST(0 AS BIGINT), false FROM entry2 GROUP BY archive
  UNION ALL SELECT f.archive, e.idx, CASE WHEN len(codes) = 0 AND NOT is_dir AND f.total + uncompressed_size <= 60 THEN f.total + uncompressed_size ELSE f.total END, f.total + uncompressed_size > 60
  FROM fold f JOIN entry2 e ON e.archive = f.archive AND e.idx = f.idx + 1),
entry AS (SELECT e.*, codes || (CASE WHEN over THEN ['ARCHIVE_UNCOMPRESSED_LIMIT'] ELSE [] END) AS issues,
  CASE WHEN len(codes) > 0 OR over THEN 'rejected' WHEN is_dir THEN 'ignored' ELSE 'registered' END AS status FROM entry2 e JOIN fold f ON e.archive = f.archive AND e.idx = f.idx)"""


def nodes(spark: SparkSession, d: str) -> DataFrame:
    """Regions, nations, suppliers and customers as a tree; customers of some nations point to a node that isn't there."""
    r = table(spark, d, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("node_id"), F.lit(None).cast("string").alias("parent_id"), F.lit("source_pack").alias("node_type"), F.col("r_name").alias("title"))
    n = table(spark, d, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("node_id"), F.concat(F.lit("r"), "n_regionkey").alias("parent_id"), F.lit("document").alias("node_type"), F.col("n_name").alias("title"))
    s = table(spark, d, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("node_id"), F.concat(F.lit("n"), "s_nationkey").alias("parent_id"), F.lit("section").alias("node_type"), F.col("s_name").alias("title"))
    c = table(spark, d, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("node_id"), F.concat(F.lit("n"), F.col("c_nationkey") + F.when(F.col("c_custkey") % 13 == 0, 100).otherwise(0)).alias("parent_id"), F.lit("page").alias("node_type"), F.col("c_name").alias("title"))
    return r.unionByName(n).unionByName(s).unionByName(c)


NODES = """nodes AS (SELECT 'r' || r_regionkey AS node_id, NULL AS parent_id, 'source_pack' AS node_type, r_name AS title FROM region
  UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, 'document', n_name FROM nation UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey, 'section', s_name FROM supplier
  UNION ALL SELECT 'c' || c_custkey, 'n' || (c_nationkey + CASE WHEN c_custkey % 13 = 0 THEN 100 ELSE 0 END), 'page', c_name FROM customer)"""


#: Nodes of a chain, and of the cycle that every other chain begins with.
CHAIN, CYCLE = 100, 20


def chains(spark: SparkSession, d: str) -> DataFrame:
    """Parts as chains of nodes, each below the part before it."""
    k = F.col("p_partkey").cast("long")
    above = F.when(k % CHAIN != 1, k - 1).when(k % (2 * CHAIN) != 1, k + (CYCLE - 1))
    return table(spark, d, "part").select(F.concat(F.lit("p"), k).alias("node_id"), F.concat(F.lit("p"), above).alias("parent_id"))


CHAINS = f"""chain AS (SELECT 'p' || p_partkey AS node_id, 'p' || CASE WHEN p_partkey % {CHAIN} <> 1 THEN p_partkey - 1 WHEN p_partkey % {2 * CHAIN} <> 1 THEN p_partkey + {CYCLE - 1} END AS parent_id FROM part)"""


def calls(spark: SparkSession, d: str) -> DataFrame:
    """Events as model calls."""
    t = table(spark, d, "events").select("event_id", "event_type", "user_id", "value", "props")
    k = F.coalesce(F.get_json_object("props", "$.k").try_cast("bigint"), F.lit(0))
    cost = (F.floor(F.coalesce("value", F.lit(0.0)) * 100).cast("decimal(20,0)") / F.lit(10000).cast("decimal(5,0)")).cast("decimal(38,10)")
    return t.select("event_id", F.col("event_type").alias("model_name"), "user_id", k.alias("input_tokens"), (k % 7).alias("output_tokens"), (k % 3).alias("cached_tokens"), cost.alias("estimated_cost"))


CALLS = """calls AS (SELECT event_id, event_type AS model_name, user_id, k AS input_tokens, k % 7 AS output_tokens, k % 3 AS cached_tokens, CAST(CAST(floor(coalesce(value, 0) * 100) AS BIGINT) AS DECIMAL(28, 0)) / 10000 AS estimated_cost
  FROM (SELECT *, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT), 0) AS k FROM events))"""
