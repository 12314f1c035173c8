"""Stable identifiers: a prefix and the first 16 hex digits of a SHA-256 over joined parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CLASSIFIER_VERSION = "0.1.0"


def _col(x: Column | str | None) -> Column:
    return F.col(x) if isinstance(x, str) else x


def text_or_empty(x: Column | str) -> Column:
    return F.coalesce(_col(x).cast("string"), F.lit(""))


def stable_id(prefix: str, *parts: Column | str, sep: str = "|") -> Column:
    """``prefix_`` and a digest of the parts; null parts count as empty, so that every part keeps its place."""
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha2(F.concat_ws(sep, *[text_or_empty(p) for p in parts]), 256), 1, 16))


def target_row_id(dictionary_id, source_name, row_number, requirement_id, expected_field) -> Column:
    return stable_id("trg", dictionary_id, source_name, row_number, requirement_id, expected_field)


def source_id(content_hash, logical_path, parent=None, member=None) -> Column:
    nothing = F.lit("")
    return stable_id("src", content_hash, logical_path, nothing if parent is None else parent, nothing if member is None else member)


def path_source_id(path, content_hash) -> Column:
    """The older identifier of a path and its content alone."""
    return stable_id("src", path, content_hash, sep="\n")


def content_identity(content_hash) -> Column:
    return F.concat(F.lit("sha256:"), _col(content_hash))


def classification_id(source, label) -> Column:
    return stable_id("cls", source, label, F.lit(CLASSIFIER_VERSION))


def group_id(kind: Column, ordered_ids: Column) -> Column:
    return F.concat(F.lit("dup_"), F.substring(F.sha2(F.concat_ws("|", kind, F.array_join(ordered_ids, "|")), 256), 1, 16))
