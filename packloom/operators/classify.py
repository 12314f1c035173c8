"""Rule classification of sources: an ordered table of rules, compiled into one CASE expression."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packloom.functions import ids
from packloom.functions.text import any_in, casefold


@dataclass(frozen=True)
class Rule:
    """Holds for the given file types (any, if none) whose text has one of the terms (always, if none)."""

    label: str
    confidence: float
    types: tuple[str, ...] = ()
    terms: tuple[str, ...] = ()
    secondary: tuple[str, ...] = ()
    alternative: tuple[str, float] | None = None


TABLES = ("xlsx", "xls", "csv")
#: Labels, confidences, terms and their order decide results.
RULES = (
    Rule("archive", 0.95, types=("zip",)),
    Rule("photograph/image", 0.85, types=("image",)),
    Rule("maintenance schedule", 0.85, TABLES, ("maintenance",), ("spreadsheet",)),
    Rule("equipment schedule", 0.85, TABLES, ("schedule", "matrix"), ("spreadsheet",)),
    Rule("spreadsheet", 0.85, TABLES, (), ("spreadsheet",)),
    Rule("individual certificate", 0.8, (), ("certificat",), ("certificate",), ("certificate pack", 0.35)),
    Rule("commissioning report", 0.82, terms=("commissioning",)),
    Rule("drawing set", 0.78, terms=("drawing", "layout", "plan")),
    Rule("technical specification", 0.78, terms=("specification",)),
    Rule("supplier manual", 0.72, terms=("supplier", "manufacturer")),
    Rule("O&M manual", 0.72, terms=("o&m", "operation", "maintenance")),
    Rule("building manual", 0.7, (), ("manual",), ("manual",), ("O&M manual", 0.45)),
    Rule("unknown", 0.25, ("pdf",), (), ("pdf",), ("mixed document", 0.2)),
    Rule("unknown", 0.1),
)


def _outcome(r: Rule) -> Column:
    none = F.array().cast("array<string>")
    alternatives = F.array().cast("array<struct<label:string,confidence:double>>")
    if r.alternative:
        alternatives = F.array(F.struct(F.lit(r.alternative[0]).alias("label"), F.lit(r.alternative[1]).alias("confidence")))
    return F.struct(
        F.lit(r.label).alias("primary_label"),
        F.lit(r.confidence).alias("confidence"),
        (F.array(*map(F.lit, r.secondary)) if r.secondary else none).alias("secondary_labels"),
        alternatives.alias("alternative_labels"),
    )


def label_of(file_type: Column, logical_path: Column, sheet_names: Column | None = None, rules: tuple[Rule, ...] = RULES) -> Column:
    """A struct of primary_label, confidence, secondary_labels and alternative_labels: those of the first rule that holds."""
    text = casefold(F.concat_ws(" ", F.coalesce(logical_path, F.lit("")), F.coalesce(sheet_names, F.lit("")) if sheet_names is not None else F.lit("")))
    out = None
    for r in rules:
        holds = F.lit(True)
        if r.types:
            holds = holds & file_type.isin(*r.types)
        if r.terms:
            holds = holds & any_in(text, r.terms)
        out = F.when(holds, _outcome(r)) if out is None else out.when(holds, _outcome(r))
    return out


def classify_sources(registry: DataFrame) -> DataFrame:
    """One classification a source: id, label, confidence, secondary and alternative labels, and a warning for unknown ones."""
    sheets = F.try_element_at("metadata", F.lit("sheet_names")) if "metadata" in registry.columns else None
    rows = registry.select("source_id", label_of(F.col("file_type"), F.col("logical_path"), sheets).alias("c")).select("source_id", "c.*")
    return rows.select(
        ids.classification_id("source_id", "primary_label").alias("classification_id"),
        F.lit("source_document").alias("classification_stage"),
        F.lit("source").alias("subject_type"),
        F.col("source_id").alias("subject_id"),
        "primary_label",
        "secondary_labels",
        "confidence",
        "alternative_labels",
        F.lit("The first rule that holds for the file's type, path and sheets.").alias("rationale"),
        F.lit("rule").alias("method_type"),
        F.when(F.col("primary_label") == "unknown", F.array(F.lit("unknown classification"))).otherwise(F.array().cast("array<string>")).alias("warnings"),
    )


def with_overrides(classifications: DataFrame, overrides: DataFrame) -> DataFrame:
    """``effective_label``: a human's label (subject_id, override_label) where there is one, else the primary label, which stays."""
    return classifications.join(overrides.select("subject_id", "override_label"), "subject_id", "left").withColumn("effective_label", F.coalesce("override_label", "primary_label"))
