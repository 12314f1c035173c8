"""Dictionary files: read the sheet, bind its columns, normalise its rows, summarise."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packloom.functions import text as T
from packloom.operators import dictionary as D
from packloom.operators.timings import DICTIONARY_STAGES, Clock
from packloom.sources.records import RANGE_BYTES
from packloom.sources.sheets import SheetError, sheet_rows, sheets_of


@dataclass
class DictionaryResult:
    mapping: D.Mapping
    rows: DataFrame
    results: DataFrame
    duplicates: DataFrame
    summary: DataFrame
    metadata: dict
    timings: dict[str, float]

    def release(self) -> None:
        self.results.unpersist()

    @property
    def targets(self) -> DataFrame:
        return self.results.where(D.NORMALIZED).select("target.*")

    @property
    def issues(self) -> DataFrame:
        return D.issue_rows(self.results)


def _base(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def headers_of(raw: DataFrame, header_row: int) -> list[str]:
    row = raw.where(F.col("row_number") == header_row).select("cells").first()
    if row is None:
        raise SheetError(f"header row {header_row} is outside the file")
    return [(v or "").strip() for v in row.cells]


def unique_names(headers: list[str]) -> list[str]:
    seen: dict[str, int] = {}
    out = []
    for i, h in enumerate(headers, 1):
        base = h or f"blank_column_{i}"
        seen[base] = seen.get(base, 0) + 1
        out.append(base if seen[base] == 1 else f"{base}__{seen[base]}")
    return out


def keyed_rows(raw: DataFrame, names: list[str], header_row: int) -> DataFrame:
    """Rows below the header as maps from column names; short rows are padded, cells beyond the header dropped, texts cleaned."""
    after = raw.where(F.col("row_number") > header_row)
    places = F.sequence(F.lit(0), F.lit(len(names) - 1)) if names else F.array().cast("array<int>")
    cell = lambda a: F.transform(places, lambda i: F.get(a, i))
    kinds = cell(F.col("types"))
    cleaned = F.zip_with(cell(F.col("cells")), kinds, lambda v, k: F.when(k == "str", T.clean_cell(v)).otherwise(v))
    keys = F.array(*map(F.lit, names)) if names else F.array().cast("array<string>")
    return after.select("row_number", F.map_from_arrays(keys, cleaned).alias("cells"), F.map_from_arrays(keys, kinds).alias("types"))


def _selected(spark: SparkSession, path: str, sheet: str | None, header_row: int, range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, list[str], str]:
    names = sheets_of(path)
    if sheet is not None and names and sheet not in names:
        raise SheetError(f"no worksheet {sheet!r}; there are {names}")
    if not path.lower().rstrip("/").endswith((".csv", ".xlsx")):
        raise SheetError(f"neither a CSV file nor a workbook: {path}")
    raw = sheet_rows(spark, path, sheet if names else None, range_bytes).cache()
    return raw, headers_of(raw, header_row), (sheet or names[0]) if names else _base(path)


def sheet_counts(rows: DataFrame) -> DataFrame:
    """physical_rows and blank_rows of ``keyed_rows``, one row."""
    return rows.agg(F.count(F.lit(1)).alias("physical_rows"), F.count_if(D.blank_row(F.col("cells"))).alias("blank_rows"))


def sheet_cells(rows: DataFrame) -> DataFrame:
    """(column, value, type) of all cells of ``keyed_rows``."""
    return rows.select(F.explode(F.arrays_zip(F.map_keys("cells").alias("column"), F.map_values("cells").alias("value"), F.map_values("types").alias("type"))).alias("c")).select("c.*")


def inspected_rows(spark: SparkSession, path: str, sheet: str | None = None, header_row: int = 1, range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, DataFrame, list[str], str]:
    """A sheet's rows below the header; the cached rows that they are made of, for the caller to unpersist; the header; the source's name."""
    raw, headers, source = _selected(spark, path, sheet, header_row, range_bytes)
    return keyed_rows(raw, unique_names(headers), header_row), raw, headers, source


def inspect_dictionary(spark: SparkSession, path: str, sheet: str | None = None, header_row: int = 1) -> dict[str, object]:
    """Counts and columns of a sheet, without normalising it."""
    rows, raw, headers, source = inspected_rows(spark, path, sheet, header_row)
    n = sheet_counts(rows).first()
    mixed = {r["column"]: r.types for r in D.mixed_types(sheet_cells(rows)).collect()}
    raw.unpersist()
    return {
        "source_name": source,
        "sheet_names": sheets_of(path),
        "columns": unique_names(headers),
        "physical_rows": n.physical_rows,
        "blank_rows": n.blank_rows,
        "non_target_rows": n.blank_rows,
        "duplicate_or_blank_columns": sorted({h for h in headers if h == "" or headers.count(h) > 1}),
        "mixed_type_columns": mixed,
    }


def ingest_dictionary(
    spark: SparkSession, path: str, config: dict = D.TEMPLATE, sheet: str | None = None, progress: Callable[[str, str], None] | None = None, range_bytes: int = RANGE_BYTES
) -> DictionaryResult:
    """Targets, issues and counts of a dictionary file; a CSV file may be a folder of parts, and tasks read ranges of ``range_bytes`` of it. SheetError and MappingError tell files and columns that can't be used."""
    clock = Clock(progress, DICTIONARY_STAGES)
    header_row = int(config.get("header_row", 1)) if isinstance(config, dict) else 1
    with clock("file_read_ms", path):
        sheets = sheets_of(path)
    with clock("worksheet_read_ms", path):
        raw, headers, source = _selected(spark, path, sheet, header_row, range_bytes)
    names = unique_names(headers)
    mapping = D.bind_columns(config, names)
    rows = keyed_rows(raw, names, header_row)
    with clock("normalization_ms", path):
        results = D.normalize_rows(rows, mapping, source, _base(path)).persist()
        results.count()
    raw.unpersist()
    with clock("validation_ms", path):
        found = D.duplicate_findings(results)
        summary = D.summary(results, mapping)
    metadata = {
        "dictionary_path": path,
        "dictionary_filename": _base(path),
        "dictionary_id": mapping.dictionary_id,
        "source_name": source,
        "format": path.rstrip("/").rsplit(".", 1)[-1].lower(),
        "sheet_names": sheets,
        "selected_sheet": source if sheets else None,
        "header_row": header_row,
        "columns": names,
        "mapping_version": mapping.mapping_version,
        "ingestion_version": D.VERSION,
        "ingested_at": datetime.now(UTC).isoformat(),
    }
    return DictionaryResult(mapping, rows, results, found, summary, metadata, clock.total)
