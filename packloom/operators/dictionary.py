"""Data-dictionary rows: column binding (on the driver), normalisation (one projection), validation and summaries."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from packloom.functions import ids, text as T
from packloom.functions.barrier import held

VERSION = "0.2.0"

#: The fields of the extraction template, their header names, and the evidence rules.
TEMPLATE = {
    "mapping_version": "extraction-template-v1",
    "dictionary_id": "extraction_template",
    "header_row": 1,
    "required_source_columns": ["Field Name", "Term Name", "Sub-Domain", "Field Label"],
    "columns": {
        "expected_field": {"aliases": ["Field Name"]},
        "requirement_id": {"aliases": ["Data Requirement id", "Data Requirement ID"]},
        "requirement_name": {"aliases": ["Term Name"]},
        "sub_domain": {"aliases": ["Sub-Domain", "Sub Domain"]},
        "field_label": {"aliases": ["Field Label"]},
        "requirement_text": {"aliases": ["Business Definition"]},
        "source_guidance": {"aliases": ["Notes"]},
        "component_type": {"aliases": ["Component Type Mapping (comes from component list)"]},
        "component_subtype": {"aliases": ["Sub-Type Mapping (comes from component sub-type list)"]},
        "cardinality": {"aliases": ["Multiple Records Possible (Y/N)"]},
        "example": {"aliases": ["Example"]},
    },
    "metadata_columns": ["requirement_name", "field_label", "example"],
    "likely_evidence_type_rules": {
        "source_guidance": {
            "certificate": ["certificate", "warranty", "test certificate"],
            "table": ["schedule", "matrix", "list"],
            "drawing": ["drawing", "plan", "layout"],
            "spreadsheet": ["spreadsheet", "workbook", "csv"],
        }
    },
}


class MappingError(ValueError):
    """Required source columns are missing or the mapping isn't a table of fields."""


def header_key(header: str) -> str:
    """The form under which headers are compared."""
    return re.sub(r"\s+", " ", header.strip().lower().replace("_", " ")).strip()


@dataclass(frozen=True)
class Mapping:
    fields: dict[str, str]
    mapping_version: str = "unknown"
    dictionary_id: str = "unknown"
    header_row: int = 1
    unused: list[str] = field(default_factory=list)
    ambiguous: list[str] = field(default_factory=list)
    metadata_fields: list[str] = field(default_factory=list)
    evidence_rules: dict[str, dict[str, list[str]]] = field(default_factory=dict)

    def warnings(self) -> list[str]:
        return [f"{x}: several source columns match, the first alias counts" for x in self.ambiguous] + [f"unmapped source column: {x}" for x in self.unused]


def bind_columns(config: dict, headers: list[str]) -> Mapping:
    """Fields bound to headers by the first alias that a header has; of headers that compare equal the last counts."""
    if not isinstance(config, dict):
        raise MappingError("a mapping is a table of fields")
    by_key = {header_key(h): h for h in headers}
    missing = [c for c in config.get("required_source_columns") or [] if header_key(str(c)) not in by_key]
    if missing:
        raise MappingError("missing required columns: " + ", ".join(map(str, missing)))
    fields, ambiguous = {}, []
    for name, rule in (config.get("columns") or {}).items():
        aliases = rule.get("aliases", []) if isinstance(rule, dict) else rule if isinstance(rule, list) else [rule]
        found = list(dict.fromkeys(by_key[k] for k in map(header_key, map(str, aliases)) if k in by_key))
        if found:
            fields[str(name)] = found[0]
        if len(found) > 1:
            ambiguous.append(str(name))
    used = set(fields.values())
    return Mapping(
        fields,
        str(config.get("mapping_version", "unknown")),
        str(config.get("dictionary_id", "unknown")),
        int(config.get("header_row", 1)),
        [h for h in headers if h not in used],
        ambiguous,
        [str(x) for x in config.get("metadata_columns") or []],
        {str(k): {str(a): [str(t) for t in b] for a, b in v.items()} for k, v in (config.get("likely_evidence_type_rules") or {}).items()},
    )


def bind_headers(headers: DataFrame, config: dict) -> dict[str, DataFrame]:
    """The binding of ``bind_columns`` for many dictionaries at once: ``headers`` has dictionary, pos and header.

    bound: dictionary, field, source_column (that of the first alias; of headers that compare equal the last counts), ambiguous (several headers match). unused: headers bound to nothing.
    missing: required columns that a dictionary lacks. Aliases are a configuration's: a few rows.
    """
    spark = headers.sparkSession
    fields = config.get("columns") or {}
    names = [(f, i, header_key(str(a))) for f, rule in fields.items() for i, a in enumerate(rule["aliases"] if isinstance(rule, dict) else rule if isinstance(rule, list) else [rule])]
    aliases = F.broadcast(spark.createDataFrame(names, "field string, place int, key string"))
    keyed = headers.withColumn("key", T.normalize_header(F.col("header")))
    last = keyed.groupBy("dictionary", "key").agg(F.max_by("header", "pos").alias("header"))
    bound = last.join(aliases, "key").groupBy("dictionary", "field").agg(F.min_by("header", "place").alias("source_column"), (F.min("header") != F.max("header")).alias("ambiguous"))
    unused = headers.join(bound.select("dictionary", F.col("source_column").alias("header")).distinct(), ["dictionary", "header"], "left_anti")
    required = [str(c) for c in config.get("required_source_columns") or []]
    has = keyed.groupBy("dictionary").agg(F.collect_set("key").alias("keys"))
    wanted = F.array(*[F.struct(F.lit(c).alias("source_column"), F.lit(header_key(c)).alias("key")) for c in required]) if required else F.array().cast("array<struct<source_column:string,key:string>>")
    missing = has.select("dictionary", F.explode(F.filter(wanted, lambda w: ~F.array_contains("keys", w["key"]))).alias("w")).select("dictionary", "w.source_column")
    return {"bound": bound, "unused": unused, "missing": missing}


def unique_headers(headers: DataFrame) -> DataFrame:
    """(pos from 1, header) with ``name``: blank ones are named by place, later ones of a name by their number in it."""
    base = F.coalesce(T.or_null(T.stripped(F.col("header"))), F.concat(F.lit("blank_column_"), F.col("pos")))
    rows = headers.withColumn("base", base)
    k = F.row_number().over(W.partitionBy("base").orderBy("pos"))
    return rows.withColumn("name", F.when(k == 1, F.col("base")).otherwise(F.concat("base", F.lit("__"), k))).drop("base")


def mixed_types(cells: DataFrame) -> DataFrame:
    """(column, type, value) rows to the columns whose non-blank values have more than one type."""
    rows = cells.where(F.col("value").isNotNull() & (T.strip(F.col("value")) != ""))
    return rows.groupBy("column").agg(F.array_sort(F.collect_set("type")).alias("types")).where(F.size("types") > 1)


def blank_row(cells: Column) -> Column:
    return F.forall(F.map_values(cells), lambda v: v.isNull() | (T.strip(v) == ""))


def _issue(when: Column, code: str, severity: str, row: Column, column: str | None, raw: Column | None = None) -> Column:
    """An issue struct where ``when`` holds."""
    message, action = MESSAGES[code]
    return F.when(
        when,
        F.struct(
            F.lit(code).alias("issue_code"),
            F.lit(severity).alias("severity"),
            row.cast("int").alias("source_row"),
            F.lit(column).cast("string").alias("source_column"),
            F.lit(message).alias("message"),
            (F.lit(None) if raw is None else raw).cast("string").alias("raw_value"),
            F.lit(action).alias("suggested_action"),
        ),
    )


#: What is said of each finding, and what to do about it.
MESSAGES = {
    "BLANK_MANDATORY_COLUMN": ("A mandatory cell is blank.", "Fill the cell."),
    "MISSING_DESCRIPTIVE_FIELD": ("Neither a name nor a definition is given.", "Give a name or a definition."),
    "MISSING_REQUIREMENT_ID": ("No requirement id; the row number stands in.", "Give an id that stays."),
    "MISSING_CARDINALITY": ("No cardinality; unknown is kept.", "Say whether several values may be given."),
    "INVALID_CARDINALITY": ("The cardinality isn't one of the known words; unknown is kept.", "Use one of the known words."),
    "UNSUPPORTED_EXPECTED_TYPE": ("Nothing suggests a type; unknown is kept.", "Name the type in the definition."),
    "MALFORMED_ACCEPTED_VALUES": ("Too many accepted values; none is kept.", "Check the list in the guidance."),
    "TARGET_SPEC_VALIDATION_FAILED": ("Accepted values differ in case alone.", "Remove values that repeat others."),
    "DUPLICATE_TARGET_ID": ("Several rows have this identity.", "Check the cells that identities are made of."),
    "DUPLICATE_PHYSICAL_ROW": ("Several rows have this number.", "Check how the file was read."),
}


def normalize_rows(rows: DataFrame, mapping: Mapping, source_name: str, file_name: str, dictionary_id: str | None = None) -> DataFrame:
    """``rows`` (row_number, cells) to row_number, disposition, target and issues; narrow projections without a shuffle.

    Blank rows are ignored. Rows with an error have no target, and their warnings aren't looked for. Each step's columns are computed once and read by
    the next ones.
    """
    did = F.lit(dictionary_id or mapping.dictionary_id)
    raw = lambda f: F.try_element_at("cells", F.lit(mapping.fields[f])) if f in mapping.fields else F.lit(None).cast("string")
    names = ["expected_field", "sub_domain", "requirement_name", "field_label", "requirement_text", "requirement_id", "component_type", "component_subtype"]
    c, n = F.col, F.col("row_number")
    stripped = {f"f_{name}": T.stripped(raw(name)) for name in names} | {"f_guidance": T.stripped(raw("source_guidance")), "f_cardinality": F.lower(T.stripped(raw("cardinality")))}
    r = held(rows.select("row_number", "cells"), stripped | {"blank": blank_row(c("cells"))})
    r = held(
        r,
        {
            "kind": T.expected_type(c("f_field_label"), c("f_requirement_text"), c("f_guidance")),
            "listed": T.listed_values(c("f_guidance")),
            "card": T.cardinality(c("f_cardinality")),
            "rid": F.coalesce(T.or_null(c("f_requirement_id")), F.concat(F.lit("row_"), n)),
            "errors": F.array_compact(
                F.array(
                    _issue(c("f_expected_field") == "", "BLANK_MANDATORY_COLUMN", "error", n, "expected_field", raw("expected_field")),
                    _issue(c("f_sub_domain") == "", "BLANK_MANDATORY_COLUMN", "error", n, "sub_domain", raw("sub_domain")),
                    _issue((c("f_requirement_name") == "") & (c("f_requirement_text") == ""), "MISSING_DESCRIPTIVE_FIELD", "error", n, "requirement_text", raw("requirement_text")),
                )
            ),
        },
    )
    r = held(
        r,
        {
            "accepted": F.when(F.size("listed") > T.MOST_ACCEPTED, F.array().cast("array<string>")).otherwise(c("listed")),
            "warnings": F.array_compact(
                F.array(
                    _issue(c("f_requirement_id") == "", "MISSING_REQUIREMENT_ID", "warning", n, mapping.fields.get("requirement_id")),
                    _issue(c("f_cardinality") == "", "MISSING_CARDINALITY", "warning", n, mapping.fields.get("cardinality")),
                    _issue((c("f_cardinality") != "") & (c("card") == "unknown"), "INVALID_CARDINALITY", "warning", n, mapping.fields.get("cardinality"), c("f_cardinality")),
                    _issue(c("kind") == "unknown", "UNSUPPORTED_EXPECTED_TYPE", "warning", n, None),
                    _issue(F.size("listed") > T.MOST_ACCEPTED, "MALFORMED_ACCEPTED_VALUES", "warning", n, mapping.fields.get("source_guidance"), c("f_guidance")),
                )
            ),
        },
    )
    clash = F.size(F.array_distinct(F.transform("accepted", T.casefold))) < F.size("accepted")
    r = held(r, {"failed": F.array_compact(F.array(_issue(clash, "TARGET_SPEC_VALIDATION_FAILED", "error", n, None)))})
    none = F.array().cast(r.schema["errors"].dataType)
    meta_fields = [f for f in mapping.metadata_fields if f in mapping.fields]
    meta = F.map_filter(F.create_map(*[x for f in meta_fields for x in (F.lit(f), raw(f))]), lambda k, v: v.isNotNull()) if meta_fields else F.create_map().cast("map<string,string>")
    target = F.struct(
        ids.target_row_id(did, F.lit(source_name), n, c("rid"), c("f_expected_field")).alias("target_row_id"),
        c("rid").alias("requirement_id"),
        c("f_sub_domain").alias("sub_domain"),
        T.requirement_text(c("f_requirement_name"), c("f_field_label"), c("f_requirement_text")).alias("requirement_text"),
        c("f_expected_field").alias("expected_field"),
        c("kind").alias("expected_data_type"),
        T.unit(c("f_guidance")).alias("unit"),
        c("card").alias("cardinality"),
        T.or_null(c("f_component_type")).alias("component_type"),
        T.or_null(c("f_component_subtype")).alias("component_subtype"),
        T.or_null(c("f_guidance")).alias("source_guidance"),
        c("accepted").alias("accepted_values"),
        T.evidence_types({"source_guidance": c("f_guidance")} | {f: raw(f) for f in mapping.evidence_rules if f != "source_guidance"}, mapping.evidence_rules).alias("likely_evidence_types"),
        meta.alias("metadata"),
        F.struct(
            did.alias("dictionary_id"),
            F.lit(file_name).alias("dictionary_path"),
            F.lit(source_name).alias("sheet_name"),
            n.cast("int").alias("row_number"),
            F.create_map(*[F.lit(x) for kv in mapping.fields.items() for x in kv]).alias("column_map"),
            F.lit(mapping.mapping_version).alias("mapping_version"),
            F.lit(VERSION).alias("ingestion_version"),
            c("f_requirement_id").alias("raw_requirement_id"),
            F.transform("warnings", lambda w: w["issue_code"]).alias("normalization_warnings"),
            T.compact_cells(c("cells")).alias("raw_value_provenance"),
        ).alias("provenance"),
    )
    bad = (F.size("errors") > 0) | (F.size("failed") > 0)
    disposition = F.when(c("blank"), "ignored_blank").when(bad, "rejected").when(F.size("warnings") > 0, "normalized_with_warnings").otherwise("normalized")
    issues = F.when(c("blank"), none).when(F.size("errors") > 0, c("errors")).otherwise(F.concat("warnings", "failed"))
    r = held(r, {"disposition": disposition, "issues": issues})
    return r.select("row_number", "disposition", F.when(F.expr(NORMALIZED), target).alias("target"), "issues")


#: Rows that have a target.
NORMALIZED = "disposition IN ('normalized', 'normalized_with_warnings')"


def duplicate_findings(results: DataFrame) -> DataFrame:
    """Target ids and row numbers that more than one row has: issue_code, raw_value, and the rows."""
    targets = results.where(NORMALIZED).select(F.lit("DUPLICATE_TARGET_ID").alias("issue_code"), F.col("target.target_row_id").alias("raw_value"), "row_number")
    physical = results.select(F.lit("DUPLICATE_PHYSICAL_ROW").alias("issue_code"), F.col("row_number").cast("string").alias("raw_value"), "row_number")
    both = targets.unionByName(physical)
    often = both.groupBy("issue_code", "raw_value").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return both.join(often, ["issue_code", "raw_value"]).groupBy("issue_code", "raw_value").agg(F.array_sort(F.collect_list("row_number")).alias("rows"))


def finding_issues(findings: DataFrame) -> DataFrame:
    """Findings of ``duplicate_findings`` as issue rows."""
    text = lambda i: F.create_map(*[F.lit(x) for k in ("DUPLICATE_TARGET_ID", "DUPLICATE_PHYSICAL_ROW") for x in (k, MESSAGES[k][i])])[F.col("issue_code")]
    return findings.select("issue_code", F.lit("error").alias("severity"), F.element_at("rows", 1).cast("int").alias("source_row"), F.lit(None).cast("string").alias("source_column"), text(0).alias("message"), "raw_value", text(1).alias("suggested_action"))


def summary(results: DataFrame, mapping: Mapping | None = None) -> DataFrame:
    """One row of counts, in one pass over the results; physical = blank + candidate and candidate = normalized + rejected. The maps have an entry for each sub-domain, type and evidence type."""
    pair = lambda m, k: F.struct(F.lit(m).alias("m"), k.alias("k"))
    t = F.col("target")
    good = F.concat(
        F.array(pair("id", t["target_row_id"]), pair("sub_domain", t["sub_domain"]), pair("type", t["expected_data_type"])),
        F.transform(t["likely_evidence_types"], lambda e: pair("evidence", e)),
    )
    every = results.select(F.explode(F.concat(F.array(pair("row", F.col("disposition"))), F.when(F.expr(NORMALIZED), good).otherwise(F.array().cast("array<struct<m:string,k:string>>")))).alias("p"))
    counts = every.groupBy("p.m", "p.k").agg(F.count(F.lit(1)).alias("n"))
    m, k, n = (F.col(c) for c in ("m", "k", "n"))
    rows = lambda *of: F.coalesce(F.sum(F.when((m == "row") & (k.isin(*of) if of else F.lit(True)), n)), F.lit(0))
    bars = lambda of: F.map_from_entries(F.array_sort(F.collect_list(F.when(m == of, F.struct("k", "n")))))
    out = counts.agg(
        rows().alias("physical_rows"),
        rows("ignored_blank").alias("blank_rows"),
        (rows() - rows("ignored_blank")).alias("candidate_rows"),
        rows("normalized", "normalized_with_warnings").alias("normalized_rows"),
        rows("normalized_with_warnings").alias("rows_with_warnings"),
        rows("rejected").alias("rejected_rows"),
        F.count_if(m == "id").alias("unique_ids"),
        F.count_if((m == "id") & (n > 1)).alias("duplicate_ids"),
        bars("sub_domain").alias("counts_by_sub_domain"),
        bars("type").alias("counts_by_expected_type"),
        bars("evidence").alias("counts_by_likely_evidence_type"),
    )
    lists = {"unmapped_columns": mapping.unused if mapping else [], "ambiguous_mappings": mapping.ambiguous if mapping else []}
    return out.withColumns({k: F.array(*map(F.lit, v)).cast("array<string>") for k, v in lists.items()})


def histogram(df: DataFrame, column: Column | str, name: str = "value") -> DataFrame:
    """Values and their counts, by value."""
    return df.select((F.col(column) if isinstance(column, str) else column).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n")).orderBy(name)


def evidence_histogram(results: DataFrame) -> DataFrame:
    return histogram(results.where(NORMALIZED), F.explode("target.likely_evidence_types"), "evidence_type")


def issue_rows(results: DataFrame) -> DataFrame:
    return results.select(F.explode("issues").alias("i")).select("i.*")
