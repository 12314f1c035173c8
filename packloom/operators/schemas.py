"""Explicit schemas and value domains; rows are never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Records of the engine's tables and contracts, as struct types. Fields are named as in the contracts.
ISSUE = "struct<issue_code:string,severity:string,source_row:int,source_column:string,message:string,raw_value:string,suggested_action:string>"
SOURCE_ISSUE = "struct<issue_code:string,severity:string,source_path:string,archive_member_path:string,message:string,raw_value:string,suggested_action:string>"
WARNING_ITEM = "struct<code:string,message:string,severity:string>"
PROVENANCE_REF = "struct<source_id:string,node_id:string,page_or_sheet:string,text_ref:string,table_ref:string,region_ref:string,notes:string>"
BOUNDING_BOX = "struct<x:double,y:double,width:double,height:double,coordinate_system:string>"
TEXT_EVIDENCE = "struct<unit_id:string,node_id:string,text_ref:string,excerpt:string,page_or_sheet:string,relevance_reason:string>"
TABLE_EVIDENCE = "struct<unit_id:string,node_id:string,table_ref:string,page_or_sheet:string,header_hint:string,relevance_reason:string>"
VISUAL_EVIDENCE = f"struct<ref_id:string,node_id:string,image_ref:string,crop_ref:string,region_ref:string,bounding_box:{BOUNDING_BOX},page_or_sheet:string>"
RETRIEVAL_SCORE = "struct<item_id:string,score:double,strategy:string,reason:string>"
EVIDENCE_BUNDLE = (
    "struct<bundle_id:string,target_row_id:string,candidate_document_ids:array<string>,candidate_section_ids:array<string>,selected_pages_or_sheets:array<string>,"
    f"text_evidence_units:array<{TEXT_EVIDENCE}>,table_evidence_units:array<{TABLE_EVIDENCE}>,visual_evidence_refs:array<{VISUAL_EVIDENCE}>,component_context:map<string,string>,"
    f"retrieval_scores:array<{RETRIEVAL_SCORE}>,retrieval_strategy:string,selection_reasons:array<string>,provenance:array<{PROVENANCE_REF}>,warnings:array<string>>"
)
CANDIDATE = (
    "struct<target_row_id:string,requirement_id:string,candidate_value:string,normalized_value:string,unit:string,source_id:string,page_or_sheet:string,"
    f"evidence_references:array<{PROVENANCE_REF}>,capability_id:string,model_name:string,confidence:double,reasoning_summary:string,warnings:array<string>,raw_structured_response_ref:string>"
)
FINDING = "struct<check:string,status:string,message:string,evidence_refs:array<string>>"
STAGE_TIMING = "struct<stage:string,duration_ms:double>"
RETRIEVAL_TELEMETRY = "struct<strategy:string,target_row_id:string,candidate_count:bigint,selected_count:bigint>"
MODEL_CALL = "struct<provider:string,model_name:string,input_tokens:bigint,output_tokens:bigint,cached_tokens:bigint,estimated_cost:decimal(38,10)>"
RUN_TELEMETRY = (
    f"struct<stage_timings:array<{STAGE_TIMING}>,document_count:bigint,page_or_sheet_count:bigint,retrieval_operations:array<{RETRIEVAL_TELEMETRY}>,candidate_count:bigint,"
    f"model_calls:array<{MODEL_CALL}>,accepted_values:bigint,rejected_values:bigint,warnings:array<string>,failures:array<string>>"
)

# The domains of enumerated columns.
DOMAINS = {
    "expected_data_type": ("string", "integer", "decimal", "boolean", "date", "enum", "list", "object", "unknown"),
    "cardinality": ("single", "multiple", "optional", "conditional", "unknown"),
    "evidence_type": ("text", "table", "drawing", "image", "ocr_text", "spreadsheet", "certificate", "human_review", "unknown"),
    "file_type": ("pdf", "xlsx", "xls", "csv", "text", "json", "zip", "image", "unknown"),
    "extraction_status": ("registered", "registered_with_warnings", "index_pending", "indexed", "ignored", "rejected", "unsupported", "failed"),
    "dictionary_disposition": ("normalized", "normalized_with_warnings", "rejected", "ignored_blank"),
    "source_disposition": ("registered", "registered_with_warnings", "rejected", "ignored"),
    "severity": ("info", "warning", "error"),
    "duplicate_type": ("identical_content", "duplicate_relative_path", "duplicate_archive_member_path", "same_filename_different_content", "same_content_different_filenames"),
    "classification_stage": ("source_document", "page_evidence_type", "domain_component", "extraction_route"),
    "subject_type": ("source", "document", "section", "page", "sheet", "evidence_unit", "evidence_bundle", "target_specification"),
    "method_type": ("rule", "model", "hybrid", "human"),
    "node_type": ("source_pack", "document", "section", "subsection", "page", "sheet", "text_block", "table", "drawing", "image_region"),
    "validation_status": ("accepted_exact", "accepted_normalized", "rejected_unsupported", "rejected_wrong_component", "rejected_wrong_field", "rejected_schema", "rejected_unit", "review_required"),
}
VALIDATION_CHECKS = ("evidence_grounding", "component_identity", "field_semantics", "data_type", "unit", "cardinality", "reference_list", "conflict", "duplicate")
VALIDATION_RESULT = (
    "struct<target_row_id:string,candidate_id:string,status:string," + ",".join(f"{c}_result:{FINDING}" for c in VALIDATION_CHECKS) + f",reviewer_notes:string,findings:array<{FINDING}>>"
)


def fields(record: str) -> StructType:
    """The fields of a record above."""
    return StructType.fromDDL(record.removeprefix("struct<").removesuffix(">"))


def table_of(spark: SparkSession, record: str, rows: list | None = None) -> DataFrame:
    """A table of records above."""
    return spark.createDataFrame(rows or [], fields(record))


def unknown_columns(columns: list[str], schema: list[str]) -> list[str]:
    """Columns that a strict schema doesn't have."""
    return sorted(set(columns) - set(schema))
