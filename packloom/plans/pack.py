"""Source packs: discover, sniff, hash, describe, expand archives, classify, group duplicates, summarise."""

from __future__ import annotations

import csv
import hashlib
import io
import os
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packloom.functions import files, ids
from packloom.functions.barrier import held
from packloom.functions.text import casefold, or_null
from packloom.operators import classify, duplicates, members, timings
from packloom.operators.dictionary import histogram
from packloom.operators.members import ArchiveLimits
from packloom.operators.schemas import SOURCE_ISSUE
from packloom.sources.archives import PLACE, extract_members, list_archives, open_source
from packloom.sources.pack_files import pack_files
from packloom.sources.records import CELL_LIMIT
from packloom.sources.shared import remove_dir, scratch, written
from packloom.sources.sheets import SheetError, sheet_names

VERSION = "0.4.0"
HEADER_COLUMNS = 50
Progress = Callable[[str, str], None]


@dataclass
class PackResult:
    """Tables of one run; all are DataFrames but the id, the times and the root. ``release`` gives back what is kept of them."""

    source_pack_id: str
    root_path: str
    created_at: datetime
    discovered: DataFrame
    registry: DataFrame
    archives: DataFrame
    members: DataFrame
    classifications: DataFrame
    duplicates: DataFrame
    issues: DataFrame
    summary: DataFrame
    file_timings: DataFrame
    timings: dict[str, float]
    kept: list[str] = field(default_factory=list, repr=False)

    def release(self) -> None:
        """Delete the run's scratch tables, which its tables read."""
        while self.kept:
            remove_dir(self.kept.pop())


def source_pack_id(root: str) -> str:
    """An id of the pack's resolved place."""
    place = root if "://" in root else os.path.realpath(root)
    return "sp_" + hashlib.sha256(place.casefold().encode()).hexdigest()[:16]


def discover(spark: SparkSession, root: str, hashed: bool = True) -> tuple[DataFrame, str]:
    """Every file with its type and disposition, as a written table, and its folder; unless hashed only heads are read."""
    rows, listing = pack_files(spark, root, hashed)
    rows = held(rows, {"detected_type": files.file_type(F.col("head"), F.col("file_name"))})
    rows = rows.withColumns({"extension": files.extension(F.col("file_name")), "disposition": files.disposition(F.col("file_name"), F.col("detected_type"), F.col("error").isNull())})
    folder = scratch(spark, "discovered")
    out = written(rows, folder)
    for x in listing:
        remove_dir(x)
    return out, folder


def _facts_of(kind: str, stream) -> dict[str, str]:
    if kind == "xlsx":
        names = sheet_names(stream)
        return {"sheet_count": str(len(names)), "sheet_names": "|".join(names)}
    csv.field_size_limit(CELL_LIMIT)
    header = next(csv.reader(io.TextIOWrapper(stream, "utf-8-sig", newline="")), [])
    return {"column_count": str(len(header)), "columns": "|".join(header[:HEADER_COLUMNS])}


def _sheet_facts(rows: DataFrame) -> DataFrame:
    """Adds ``facts`` (a map), ``trouble`` and ``facts_ms``. Only workbooks and CSV files are opened, where they lie; of a CSV file the first record is read."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            facts, trouble, took = [], [], []
            for kind, path, content in zip(batch.column("file_type").to_pylist(), batch.column("original_path").to_pylist(), batch.column("content")):
                found, problem, start = {}, None, time.perf_counter()
                try:
                    with open_source(path, content.as_py()) as stream:
                        found = _facts_of(kind, stream)
                except (SheetError, UnicodeDecodeError, csv.Error, OSError) as e:
                    problem = f"metadata can't be read: {str(e)[:150]}"
                facts.append(list(found.items()))
                trouble.append(problem)
                took.append((time.perf_counter() - start) * 1000)
            new = [pa.array(facts, pa.map_(pa.string(), pa.string())), pa.array(trouble, pa.string()), pa.array(took, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, "facts", "trouble", "facts_ms"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    sheets = F.col("file_type").isin("xlsx", "csv")
    looked = rows.where(sheets).mapInArrow(look, f"{schema}, facts map<string,string>, trouble string, facts_ms double")
    none = {"facts": F.lit(None).cast("map<string,string>"), "trouble": F.lit(None).cast("string"), "facts_ms": F.lit(0.0)}
    return rows.where(~sheets).withColumns(none).unionByName(looked)


def register(rows: DataFrame) -> DataFrame:
    """Registry rows of (logical_path, original_path, sha256, size_bytes, bytes_read, head, pdf_markers, content, parent_archive_source_id, archive_member_path, archive_depth, hash_ms)."""
    name = files.file_name(F.col("logical_path"))
    rows = held(rows, {"file_type": files.file_type(F.col("head"), F.coalesce(files.file_name(F.col("archive_member_path")), name))})
    rows = _sheet_facts(rows)
    kind = F.col("file_type")
    pdf = F.create_map(F.lit("page_count"), or_null(F.col("pdf_markers").cast("string")), F.lit("header_text"), files.pdf_header(F.col("head")))
    described = (
        F.when(kind == "pdf", F.map_filter(pdf, lambda k, v: (k != "page_count") | (v != "0")))
        .when(kind == "text", F.create_map(F.lit("header_text"), files.text_header(F.col("head"))))
        .when(kind == "image", F.create_map(F.lit("image_filename"), name))
        .otherwise(F.col("facts"))
    )
    no_pages = (kind == "pdf") & (F.col("pdf_markers") == 0)
    warnings = F.array_compact(F.array(F.when(no_pages, F.lit("no page count can be told")), F.col("trouble")))
    rows = held(rows, {"metadata": described, "warnings": warnings})
    count = lambda k: F.try_element_at("metadata", F.lit(k)).try_cast("int")
    source_id = ids.source_id("sha256", "logical_path", F.col("parent_archive_source_id"), F.col("archive_member_path"))
    label = classify.label_of(kind, F.col("logical_path"), F.try_element_at("metadata", F.lit("sheet_names")))["primary_label"]
    return rows.select(
        source_id.alias("source_id"),
        "original_path",
        "logical_path",
        "file_type",
        files.extension(F.coalesce(files.file_name(F.col("archive_member_path")), name)).alias("extension"),
        files.mime_type(F.col("head"), kind).alias("mime_type"),
        F.col("sha256").alias("file_hash"),
        F.lit("sha256").alias("hash_algorithm"),
        "size_bytes",
        "bytes_read",
        count("page_count").alias("page_count"),
        count("sheet_count").alias("sheet_count"),
        F.when(F.size("warnings") > 0, "registered_with_warnings").otherwise("registered").alias("extraction_status"),
        label.alias("classification"),
        "warnings",
        "parent_archive_source_id",
        "archive_member_path",
        "archive_depth",
        ids.content_identity("sha256").alias("content_identity"),
        F.lit(VERSION).alias("ingestion_version"),
        "metadata",
        F.col("hash_ms").alias("hash_duration_ms"),
        F.col("facts_ms").alias("metadata_ms"),
        "content",
    )


def _as_sources(found: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    return found.select(
        F.col("path").alias("original_path"), F.col("relative_path").alias("logical_path"), "sha256", "size_bytes", "bytes_read", "head", "pdf_markers", F.lit(None).cast("binary").alias("content"),
        none.alias("parent_archive_source_id"), none.alias("archive_member_path"), F.lit(0).alias("archive_depth"), "hash_ms",
    )


def _children(entries: DataFrame) -> DataFrame:
    """Extracted members as sources; their logical path is their archive's and their own."""
    path = F.concat_ws("!/", "archive_path", "member_path")
    return entries.select(
        path.alias("original_path"),
        path.alias("logical_path"),
        "sha256",
        "size_bytes",
        F.col("size_bytes").alias("bytes_read"),
        "head",
        "pdf_markers",
        "content",
        F.col("archive").alias("parent_archive_source_id"),
        F.col("member_path").alias("archive_member_path"),
        (F.col("archive_depth") + 1).alias("archive_depth"),
        F.lit(0.0).alias("hash_ms"),
    )


def ingest_source_pack(spark: SparkSession, root: str, limits: ArchiveLimits = ArchiveLimits(), fail_on_unreadable: bool = False, progress: Progress | None = None) -> PackResult:
    """All tables of a pack. One unreadable file doesn't stop the run unless ``fail_on_unreadable``; ignored files are listed only.

    Archives are opened level by level down to ``limits.max_depth``; members of the last level are listed but not registered. ``progress`` is told each stage as it begins.
    Files are never held whole, members of archives up to the limit on their size.
    """
    clock, kept = timings.Clock(progress), []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(scratch(spark, "pack"))
        return written(df, kept[-1])

    with clock("discovery_ms", root):  # files are hashed as they are read
        found, folder = discover(spark, root)
        kept.append(folder)
    lost = F.col("sha256").isNull() & F.col("disposition").isin("registered", "registered_with_warnings", "rejected")
    if fail_on_unreadable and (bad := found.where(lost).select("relative_path", "error").first()):
        raise OSError(f"{bad.relative_path}: {bad.error}")
    with clock("metadata_ms", root):
        level = keep(register(_as_sources(found.where(~lost & (F.col("disposition") != "ignored")))))
    registry, heads, entries = [level], [], []
    for depth in range(limits.max_depth + 1):
        zips = level.where("file_type = 'zip'")
        with clock("archive_ms", f"depth {depth}"):
            listed = keep(list_archives(zips, limits))
            heads.append(listed.where("idx IS NULL").select("archive", "archive_path", "archive_depth", "entries", "corrupt", "duration_ms"))
            checked = members.check_members(listed.where("idx IS NOT NULL").drop("entries", "corrupt", "duration_ms"), limits)
            passed = checked.where("status = 'registered'").select("archive", "idx", "member_path", *PLACE)
            data = keep(extract_members(zips, passed))
            checked = checked.drop("header_offset", "method", "stored_name")
        broken = F.lit("ARCHIVE_EXTRACTION_FAILED")
        checked = checked.join(data.select("archive", "idx", "failure", "duration_ms"), ["archive", "idx"], "left")
        failed = F.col("failure").isNotNull()
        checked = checked.withColumns({"issues": F.when(failed, F.concat("issues", F.array(broken))).otherwise(F.col("issues")), "status": F.when(failed, "rejected").otherwise(F.col("status"))})
        entries.append(keep(checked))
        if depth == limits.max_depth:
            break
        with clock("metadata_ms", f"depth {depth + 1}"):
            level = keep(register(_children(data.where("failure IS NULL"))))
        registry.append(level)
    every, opened, inner = (_union(x) for x in (registry, heads, entries))
    sources = keep(every.drop("content"))
    counts = members.archive_summaries(inner)
    archives = opened.join(counts, "archive", "left").na.fill(0, counts.columns[1:])
    codes = F.array_compact(F.array(F.when(F.col("corrupt").isNotNull(), "CORRUPT_ARCHIVE"), F.when(F.col("entries") > limits.max_member_count, "ARCHIVE_MEMBER_LIMIT")))
    archives = archives.withColumn("issues", codes)
    with clock("classification_ms", root):
        classes = keep(classify.classify_sources(sources))
    with clock("duplicate_detection_ms", root):
        groups = keep(duplicates.all_groups(sources))
    clock.total["hashing_ms"] = sources.agg(F.coalesce(F.sum("hash_duration_ms"), F.lit(0.0))).first()[0]
    archives, inner = keep(archives), keep(inner)
    issues = pack_issues(found, archives, inner)
    files_took = timings.file_timings(found, sources, archives, inner, timings.shared_out(clock.total["classification_ms"], sources))
    summary = pack_summary(found, sources, archives, groups, classes, issues)
    return PackResult(source_pack_id(root), root, datetime.now(UTC), found.drop("head"), sources, archives, inner, classes, groups, issues, summary, files_took, clock.total, kept)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


#: What is said of each finding, how bad it is, and what to do about it.
ISSUES = {
    "SOURCE_REGISTRATION_FAILED": ("error", "The file can't be registered.", "Check its permissions, or whether it is damaged."),
    "UNREADABLE_FILE": ("error", "The file can't be read.", "Check its permissions, or whether it is damaged."),
    "UNSUPPORTED_FILE_TYPE": ("warning", "Nothing handles files of this type.", "Convert the file, or add a handler."),
    "CORRUPT_ARCHIVE": ("error", "The ZIP archive can't be read.", "Repair or replace the archive."),
    "ARCHIVE_MEMBER_LIMIT": ("error", "The archive has more members than are looked at.", "Check the archive before the limit is raised."),
    "ARCHIVE_ABSOLUTE_PATH": ("error", "The member's path is absolute.", "Check the archive."),
    "ARCHIVE_PATH_TRAVERSAL": ("error", "The member's path leads out of the archive.", "Check the archive."),
    "ARCHIVE_DUPLICATE_MEMBER": ("error", "An earlier member has this path.", "Check the archive."),
    "ARCHIVE_ENCRYPTED_MEMBER": ("error", "The member is encrypted.", "Check the archive."),
    "ARCHIVE_MEMBER_SIZE_LIMIT": ("error", "The member is larger than members may be.", "Check the archive before the limit is raised."),
    "ARCHIVE_COMPRESSION_RATIO_LIMIT": ("error", "The member is packed more tightly than members may be.", "Check the archive before the limit is raised."),
    "ARCHIVE_UNCOMPRESSED_LIMIT": ("error", "The archive holds more bytes than archives may.", "Check the archive before the limit is raised."),
    "ARCHIVE_EXTRACTION_FAILED": ("error", "The member's bytes can't be read.", "Check the member by hand."),
}


def _told(code: Column, i: int) -> Column:
    return F.create_map(*[F.lit(x) for k, v in ISSUES.items() for x in (k, v[i])])[code]


def _issue_rows(df: DataFrame, rank: int, origin: str, path: Column, member: Column, raw: Column) -> DataFrame:
    """Issues of rows with an array ``issues`` of codes."""
    rows = df.select(F.posexplode("issues").alias("k", "issue_code"), path.alias("source_path"), member.cast("string").alias("archive_member_path"), raw.cast("string").alias("raw_value"))
    struct = F.struct("issue_code", _told(F.col("issue_code"), 0).alias("severity"), "source_path", "archive_member_path", _told(F.col("issue_code"), 1).alias("message"), "raw_value", _told(F.col("issue_code"), 2).alias("suggested_action"))
    return rows.select(F.lit(origin).alias("origin"), struct.cast(SOURCE_ISSUE).alias("i"), F.struct(F.lit(rank).alias("rank"), "source_path", "archive_member_path", "k").alias("place")).select("origin", "i.*", "place")


def pack_issues(found: DataFrame, archives: DataFrame, checked: DataFrame) -> DataFrame:
    """(origin, issue_code, severity, source_path, archive_member_path, message, raw_value, suggested_action, place) of registration, files, archives and members; ``place`` orders them so."""
    none, code = F.lit(None).cast("string"), lambda when, x: F.array_compact(F.array(F.when(when, x)))
    bad = found.where(F.col("error").isNotNull())
    failed = _issue_rows(bad.withColumn("issues", F.array(F.lit("SOURCE_REGISTRATION_FAILED"))), 0, "registration", F.col("relative_path"), none, none)
    file = found.withColumn("issues", F.concat(code(F.col("error").isNotNull(), F.lit("UNREADABLE_FILE")), code(F.col("disposition") == "registered_with_warnings", F.lit("UNSUPPORTED_FILE_TYPE"))))
    file = _issue_rows(file, 1, "file", F.col("relative_path"), none, F.coalesce("error", "detected_type"))
    archive = _issue_rows(archives, 2, "archive", F.col("archive_path"), none, F.when(F.col("corrupt").isNotNull(), F.col("corrupt")))
    member = _issue_rows(checked, 3, "member", F.col("archive_path"), F.col("member_path"), F.col("failure"))
    return failed.unionByName(file).unionByName(archive).unionByName(member)


def pack_summary(found: DataFrame, sources: DataFrame, archives: DataFrame, groups: DataFrame, classes: DataFrame, issues: DataFrame) -> DataFrame:
    """One row of 13 counts, in one aggregate over narrow rows of all tables, each read once; the maps have a few keys. Warnings are those of files, archives and members."""

    def facts(df: DataFrame, of: str, key: Column = F.lit(None), state: Column = F.lit(None), value: Column = F.lit(0)) -> DataFrame:
        return df.select(F.lit(of).alias("of"), key.cast("string").alias("k"), state.cast("string").alias("state"), value.cast("long").alias("v"))

    every = _union([
        facts(found, "file", F.col("detected_type"), F.col("disposition")),
        facts(sources, "source", value=F.col("size_bytes")),
        facts(archives, "archive", value=F.col("member_count")),
        facts(groups.where("part = 0"), "group", F.col("duplicate_type")),
        facts(classes, "label", F.col("primary_label")),
        facts(issues.where("origin <> 'registration'"), "code", F.col("issue_code")),
    ])
    counts = every.groupBy("of", "k").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("state") == "rejected").alias("rejected"), F.count_if(F.col("state") == "ignored").alias("ignored"), F.sum("v").alias("v"))
    of = lambda x, c, key=None: F.coalesce(F.sum(F.when((F.col("of") == x) & (F.lit(True) if key is None else F.col("k") == key), F.col(c))), F.lit(0))
    bars = lambda x: F.map_from_entries(F.array_sort(F.collect_list(F.when((F.col("of") == x) & F.col("k").isNotNull(), F.struct("k", "n")))))
    return counts.agg(
        of("file", "n").alias("files_discovered"),
        of("file", "rejected").alias("files_rejected"),
        of("file", "ignored").alias("files_ignored"),
        of("source", "n").alias("files_registered"),
        of("source", "v").alias("total_source_bytes"),
        of("archive", "n").alias("archives"),
        of("archive", "v").alias("archive_members"),
        of("group", "n", "identical_content").alias("identical_content_groups"),
        of("group", "n", "same_filename_different_content").alias("same_name_different_content_findings"),
        of("label", "n", "unknown").alias("unknown_classifications"),
        bars("file").alias("files_by_detected_type"),
        bars("label").alias("classification_counts"),
        bars("code").alias("warnings_by_code"),
    )


def inspect_source_pack(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """What a pack holds, by heads alone: files, extension counts, repeated names, archives, unsupported files; all read one written table, which stays in the shared folder."""
    found = discover(spark, root, hashed=False)[0].drop("head")
    name = casefold(F.col("file_name"))
    return {
        "files": found.select("path", "relative_path", "file_name", "extension", "detected_type", "size_bytes", "disposition"),
        "extensions": histogram(found, F.coalesce(or_null(F.col("extension")), F.lit("<none>")), "extension"),
        "duplicate_names": histogram(found, name, "name").where("n > 1"),
        "zip_archives": found.where("detected_type = 'zip'").select("relative_path"),
        "unsupported_files": found.where("disposition = 'registered_with_warnings'").select("relative_path"),
    }
