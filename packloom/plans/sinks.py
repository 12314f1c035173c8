"""Artifacts of a run. Tables are written by Spark, as folders of files; ``single_file`` has one task write a table and moves its only file into place.

The artifacts of a run appear together: they are written to a staging folder, and a failed run leaves the earlier set as it was.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packloom.operators import dictionary
from packloom.plans.dictionaries import DictionaryResult
from packloom.plans.pack import PackResult
from packloom.sources.shared import filesystem, remove_dir


def flat(df: DataFrame) -> DataFrame:
    """Arrays of strings joined by a bar, other nested columns as JSON: fit for CSV."""
    cols = []
    for f in df.schema:
        kind = f.dataType.simpleString()
        c = F.col(f"`{f.name}`")
        cols.append((F.array_join(c, "|") if kind == "array<string>" else F.to_json(c) if kind.startswith(("array", "map", "struct")) else c).alias(f.name))
    return df.select(*cols)


def _write(df: DataFrame, path: str, single_file: bool, order: list, kind: str, **options) -> None:
    """``df`` by ``order`` as files of a kind: a folder at ``path``, or one file there."""
    rows = df.repartition(1).sortWithinPartitions(*order) if single_file and order else df.orderBy(*order) if order else df.repartition(1) if single_file else df
    rows = rows.select(*[c for c in rows.columns if c != "place"])
    if not single_file:
        rows.write.mode("overwrite").format(kind).options(**options).save(path)
        return
    folder = f"{path}.{uuid.uuid4().hex}"
    rows.write.format(kind).options(**options).save(folder)
    from pyarrow import fs

    where, base = filesystem(folder)
    parts = [f.path for f in where.get_file_info(fs.FileSelector(base)) if f.base_name.startswith("part-")]
    _, target = filesystem(path)
    if where.get_file_info(target).type == fs.FileType.Directory:
        where.delete_dir(target)
    where.move(parts[0], target)
    where.delete_dir(base)


def write_jsonl(df: DataFrame, path: str, single_file: bool = False, order: list = ()) -> None:
    """A JSON object a line; fields that are null are there."""
    _write(df, path, single_file, list(order), "json", ignoreNullFields="false")


def write_csv(df: DataFrame, path: str, single_file: bool = False, order: list = ()) -> None:
    """A header and a record a row; nulls and empty texts are empty cells, quotes within cells are doubled."""
    how = {"header": "true", "escape": '"', "emptyValue": "", "nullValue": ""}
    if "place" in df.columns:  # CSV has no nested columns: it orders as text, and goes
        df, order = df.withColumn("place", F.to_json("place")), ["place"]
    _write(flat(df), path, single_file, list(order), "csv", **how)


def _text(path: str, text: str) -> None:
    where, name = filesystem(path)
    with where.open_output_stream(name) as out:
        out.write(text.encode())


def _write_json(value, path: str) -> None:
    _text(path, json.dumps(value, indent=2, default=str))


def _one(df: DataFrame) -> dict:
    return df.first().asDict(recursive=True)


def _markdown(title: str, counts: dict) -> str:
    lines = [f"# {title}", ""]
    for k, v in counts.items():
        lines += [f"## {k}", *(f"- {a}: {b}" for a, b in sorted(v.items())), ""] if isinstance(v, dict) else [f"- {k}: {v}"]
    return "\n".join(lines) + "\n"


#: Names the staging folder whose files are to take their places; Spark's readers skip names that begin so.
JOURNAL = "_commit.json"


def settle(folder: str) -> None:
    """Finish a commit that was begun and broken off: what is still staged takes its place, manifests last. Without a journal there is nothing to do."""
    from pyarrow import fs

    folder = folder.rstrip("/")
    where, base = filesystem(folder)
    journal, kind = f"{base}/{JOURNAL}", lambda x: where.get_file_info(x).type
    if kind(journal) != fs.FileType.File:
        return
    with where.open_input_stream(journal) as f:
        told = json.loads(f.read())
    for name in sorted(told["names"], key=lambda n: (n.endswith("manifest.json"), n)):
        staged, target = f"{base}/{told['staged']}/{name}", f"{base}/{name}"
        if kind(staged) == fs.FileType.NotFound:  # moved before
            continue
        if kind(target) == fs.FileType.Directory:
            where.delete_dir(target)
        elif kind(target) == fs.FileType.File:
            where.delete_file(target)
        where.move(staged, target)
    remove_dir(f"{folder}/{told['staged']}")
    where.delete_file(journal)


@contextmanager
def together(folder: str) -> Iterator[str]:
    """A staging folder in ``folder``, for one writer at a time. When the block ends, a journal is put in place by one rename: from then on the new set holds, and whoever writes next, or ``settle``, ends the moves
    should this run be killed amid them. When the block fails, the staging folder goes and the earlier set stays."""
    from pyarrow import fs

    folder = folder.rstrip("/")
    where, base = filesystem(folder)
    where.create_dir(base, recursive=True)
    settle(folder)
    name = f"_staged-{uuid.uuid4().hex}"
    stage = f"{folder}/{name}"
    where.create_dir(f"{base}/{name}", recursive=True)
    try:
        yield stage
        names = [f.base_name for f in where.get_file_info(fs.FileSelector(f"{base}/{name}"))]
        _write_json({"staged": name, "names": names}, f"{folder}/{name}.json")
        where.move(f"{base}/{name}.json", f"{base}/{JOURNAL}")
    except BaseException:
        remove_dir(stage)
        raise
    settle(folder)


PACK_ARTIFACTS = {
    "source_pack_manifest": "source_pack_manifest.json",
    "source_registry_jsonl": "source_registry.jsonl",
    "source_registry_csv": "source_registry.csv",
    "document_classifications_csv": "document_classifications.csv",
    "duplicate_groups": "duplicate_groups.json",
    "archive_manifest": "archive_manifest.json",
    "ingestion_issues_csv": "ingestion_issues.csv",
    "source_summary": "source_summary.json",
    "source_summary_md": "source_summary.md",
    "stage_timings": "stage_timings.json",
    "file_timings_csv": "file_timings.csv",
}


def write_pack(result: PackResult, folder: str, single_file: bool = False) -> dict[str, str]:
    """The artifacts of a pack by name. JSON tables have an object a line; the manifest has ids, counts, times and paths, and no rows."""
    start = time.perf_counter()
    path = {k: f"{folder.rstrip('/')}/{v}" for k, v in PACK_ARTIFACTS.items()}
    with together(folder) as stage:
        at = {k: f"{stage}/{v}" for k, v in PACK_ARTIFACTS.items()}
        by = ["logical_path", "source_id"]
        write_jsonl(result.registry, at["source_registry_jsonl"], single_file, by)
        table = result.registry.select("source_id", F.col("file_hash").alias("content_hash"), "logical_path", "file_type", "extension", "size_bytes", "page_count", "sheet_count", "parent_archive_source_id", "archive_member_path", "classification", "warnings")
        write_csv(table, at["source_registry_csv"], single_file, by)
        labels = F.transform("alternative_labels", lambda x: x["label"])
        classes = result.classifications.select("classification_id", F.col("subject_id").alias("source_id"), "primary_label", "secondary_labels", "confidence", labels.alias("alternatives"), "rationale", "method_type", "warnings")
        write_csv(classes, at["document_classifications_csv"], single_file, ["source_id"])
        write_jsonl(result.duplicates, at["duplicate_groups"], single_file, ["place"])
        write_jsonl(result.archives, at["archive_manifest"], single_file, ["archive_path"])
        write_csv(result.issues.drop("origin"), at["ingestion_issues_csv"], single_file)
        write_csv(result.file_timings, at["file_timings_csv"], single_file, ["relative_path"])
        summary = _one(result.summary)
        _write_json(summary, at["source_summary"])
        _text(at["source_summary_md"], _markdown("Source pack", summary))
        result.timings["artifact_writing_ms"] = (time.perf_counter() - start) * 1000
        _write_json(result.timings, at["stage_timings"])
        head = {"source_pack_id": result.source_pack_id, "root_path": result.root_path, "created_at": result.created_at.isoformat()}
        _write_json(head | {"summary": summary, "timings": result.timings, "output_paths": path}, at["source_pack_manifest"])
    return path


DICTIONARY_ARTIFACTS = {
    "dictionary_manifest": "dictionary_manifest.json",
    "normalized_targets_jsonl": "normalized_targets.jsonl",
    "normalized_targets_csv": "normalized_targets.csv",
    "validation_issues_csv": "validation_issues.csv",
    "dictionary_summary": "dictionary_summary.json",
    "dictionary_summary_md": "dictionary_summary.md",
    "column_mapping_report": "column_mapping_report.json",
}


def write_dictionary(result: DictionaryResult, folder: str, single_file: bool = False) -> dict[str, str]:
    """The seven artifacts of a dictionary by name."""
    start = time.perf_counter()
    path = {k: f"{folder.rstrip('/')}/{v}" for k, v in DICTIONARY_ARTIFACTS.items()}
    with together(folder) as stage:
        at = {k: f"{stage}/{v}" for k, v in DICTIONARY_ARTIFACTS.items()}
        targets = result.targets
        write_jsonl(targets, at["normalized_targets_jsonl"], single_file, ["provenance.row_number"])
        table = targets.select("target_row_id", "requirement_id", "sub_domain", "expected_field", "expected_data_type", "cardinality", "unit", "component_type", "component_subtype", F.col("provenance.row_number").alias("source_row"), "likely_evidence_types", F.col("provenance.normalization_warnings").alias("warning_codes"))
        write_csv(table, at["normalized_targets_csv"], single_file, ["source_row"])
        place = lambda df, rank: df.withColumn("place", F.struct(F.lit(rank).alias("rank"), F.format_string("%012d", F.col("source_row")).alias("row")))
        write_csv(place(result.issues, 0).unionByName(place(dictionary.finding_issues(result.duplicates), 1)), at["validation_issues_csv"], single_file)
        summary = _one(result.summary)
        _write_json(summary, at["dictionary_summary"])
        _text(at["dictionary_summary_md"], _markdown("Dictionary", summary))
        mapping = {k: getattr(result.mapping, k) for k in ("fields", "mapping_version", "dictionary_id", "header_row", "unused", "ambiguous")}
        _write_json(mapping | {"warnings": result.mapping.warnings()}, at["column_mapping_report"])
        result.timings["artifact_writing_ms"] = (time.perf_counter() - start) * 1000
        _write_json(result.metadata | {"timings": result.timings, "output_paths": path}, at["dictionary_manifest"])
    return path
