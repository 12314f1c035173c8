"""Expectations on typed records: each check returns the rows that break it. Also the evidence tree, bundles, validations and telemetry."""

from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packloom.functions.text import casefold, strip
from packloom.operators.schemas import CANDIDATE, DOMAINS, VALIDATION_CHECKS
from packloom.sources.shared import remove_dir, scratch, written


def violations(df: DataFrame, key: str, checks: dict[str, Column]) -> DataFrame:
    """(key, check) for each check that doesn't hold; a check that is null doesn't hold."""
    found = F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), name) for name, c in checks.items()]))
    return df.select(F.col(key).alias("key"), F.explode(found).alias("check"))


def not_blank(x: Column) -> Column:
    return strip(x) != ""


def in_domain(x: Column, domain: str) -> Column:
    return x.isin(*DOMAINS[domain])


def between_0_and_1(x: Column) -> Column:
    return x.between(0, 1)


def sound_range(start: Column, end: Column) -> Column:
    return (start >= 1) & (end >= start)


def sound_box(x: Column, y: Column, width: Column, height: Column) -> Column:
    return (x >= 0) & (y >= 0) & (width > 0) & (height > 0)


def repeated(df: DataFrame, key: str) -> DataFrame:
    """Keys that several rows have."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def orphans(nodes: DataFrame) -> DataFrame:
    """Nodes whose parent isn't a node."""
    parents = nodes.select(F.col("node_id").alias("parent_id")).distinct()
    return nodes.where(F.coalesce(F.col("parent_id"), F.lit("")) != "").join(parents, "parent_id", "left_anti").select("node_id", "parent_id")


def _climbed(nodes: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """Two written tables, (node_id, depth) of the nodes below a root and (node_id, up) of those that no number of steps leads out of the tree; and the folders to remove.

    Pointers double: after r rounds a node's pointer is 2**r ancestors up, so that a tree of any depth takes the logarithm of it. A node that has not come to a root or a missing parent after as many steps
    as there are nodes is on a cycle or below one; its pointer is then on it.
    """
    spark, folders = nodes.sparkSession, []

    def kept(df: DataFrame) -> DataFrame:
        folders.append(scratch(spark, "climb"))
        return written(df, folders[-1])

    root = F.coalesce(F.col("parent_id"), F.lit("")) == ""
    first = kept(nodes.select("node_id", F.when(~root, F.col("parent_id")).alias("up")).distinct())
    every = kept(first.select("node_id", "up", F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("depth")))
    steps, n = 1, every.where("up IS NOT NULL").count()
    most = n  # no node has more ancestors
    while n and steps <= most:
        ahead = every.select(F.col("node_id").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("d2"))
        moved = every.where("up IS NOT NULL").join(ahead, "up")  # what points to a missing node goes
        every = kept(every.where("up IS NULL").unionByName(moved.select("node_id", F.col("up2").alias("up"), (F.col("depth") + F.col("d2")).alias("depth"))))
        steps, n = 2 * steps, every.where("up IS NOT NULL").count()
    return every.where("up IS NULL").select("node_id", "depth"), every.where("up IS NOT NULL").select("node_id", "up"), folders


def node_paths(nodes: DataFrame) -> DataFrame:
    """node_id, path from its root and depth of every node below a root, however deep. Nodes below a missing parent, on a cycle or below one have none."""
    spark = nodes.sparkSession
    rooted, _, folders = _climbed(nodes)
    deepest = rooted.agg(F.coalesce(F.max("depth"), F.lit(0))).first()[0]
    pairs = nodes.select("node_id", F.when(F.coalesce(F.col("parent_id"), F.lit("")) != "", F.col("parent_id")).alias("up")).distinct()
    every, steps = pairs.join(rooted, "node_id").select("node_id", "up", F.col("node_id").alias("path"), "depth"), 1
    while True:
        folder = scratch(spark, "paths")
        every = written(every, folder)
        for x in folders:
            remove_dir(x)
        folders = [folder]
        if steps > deepest:
            return every.select("node_id", "path", F.col("depth").cast("int").alias("depth"))
        ahead = every.select(F.col("node_id").alias("up"), F.col("up").alias("up2"), F.col("path").alias("p"))
        moved = every.where("up IS NOT NULL").join(ahead, "up").select("node_id", F.col("up2").alias("up"), F.concat_ws("/", "p", "path").alias("path"), "depth")
        every, steps = every.where("up IS NULL").unionByName(moved), 2 * steps


def cycles(nodes: DataFrame) -> DataFrame:
    """node_id of the nodes that are their own ancestors."""
    _, stuck, folders = _climbed(nodes)
    out = written(stuck.select(F.col("up").alias("node_id")).distinct(), scratch(nodes.sparkSession, "cycles"))
    for x in folders:
        remove_dir(x)
    return out


def bundles(units: DataFrame, key: str, order: str, fields: list[str]) -> DataFrame:
    """One row a key with its evidence units as an ordered array of structs."""
    return units.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, *fields))).alias("units"), F.count(F.lit(1)).alias("n_units"))


def validation_wide(findings: DataFrame) -> DataFrame:
    """(target_row_id, check, status) findings with a column for each named check."""
    named = findings.groupBy("target_row_id").pivot("check", list(VALIDATION_CHECKS)).agg(F.min("status"))
    return named.select("target_row_id", *[F.col(c).alias(f"{c}_result") for c in VALIDATION_CHECKS])


def telemetry_totals(calls: DataFrame, *by: str) -> DataFrame:
    """Sums of tokens and cost; cached tokens aren't part of the total."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return calls.groupBy(*by).agg(
        total("input_tokens").cast("bigint").alias("input_tokens"),
        total("output_tokens").cast("bigint").alias("output_tokens"),
        total("cached_tokens").cast("bigint").alias("cached_tokens"),
        total(F.col("input_tokens") + F.col("output_tokens")).cast("bigint").alias("total_tokens"),
        total("estimated_cost").alias("estimated_cost"),
    )


def cost_per_accepted(cost: Column, accepted: Column) -> Column:
    """Null where nothing was accepted."""
    return F.try_divide(cost, F.nullif(accepted, F.lit(0)).cast("decimal(20,0)"))


def retrieval_totals(operations: DataFrame, *by: str) -> DataFrame:
    """Retrieval operations, candidates and selected items, summed."""
    return operations.groupBy(*by).agg(F.count(F.lit(1)).alias("operations"), F.sum("candidate_count").alias("candidate_count"), F.sum("selected_count").alias("selected_count"))


def _distinct_values(x: Column) -> Column:
    """Whether no two values differ in case alone."""
    return F.size(F.array_distinct(F.transform(x, casefold))) == F.size(x)


def _least(x: Column, n: int) -> Column:
    return x.isNull() | (x >= n)


#: What holds for the rows of each kind of record, by name; checks take the record's columns.
RECORD_CHECKS = {
    "source": {
        **{c: (lambda c: lambda: not_blank(F.col(c)))(c) for c in ("source_id", "original_path", "logical_path", "file_hash")},
        "file_type": lambda: in_domain(F.col("file_type"), "file_type"),
        "extraction_status": lambda: in_domain(F.col("extraction_status"), "extraction_status"),
        "size_bytes": lambda: F.col("size_bytes") >= 0,
        "page_count": lambda: _least(F.col("page_count"), 0),
        "archive_depth": lambda: F.col("archive_depth") >= 0,
    },
    "target": {
        **{c: (lambda c: lambda: not_blank(F.col(c)))(c) for c in ("target_row_id", "requirement_id", "sub_domain", "requirement_text", "expected_field")},
        "expected_data_type": lambda: in_domain(F.col("expected_data_type"), "expected_data_type"),
        "cardinality": lambda: in_domain(F.col("cardinality"), "cardinality"),
        "accepted_values": lambda: _distinct_values(F.col("accepted_values")),
        "likely_evidence_types": lambda: F.forall("likely_evidence_types", lambda e: in_domain(e, "evidence_type")),
    },
    "classification": {
        **{c: (lambda c: lambda: not_blank(F.col(c)))(c) for c in ("classification_id", "subject_id", "primary_label", "rationale")},
        "classification_stage": lambda: in_domain(F.col("classification_stage"), "classification_stage"),
        "subject_type": lambda: in_domain(F.col("subject_type"), "subject_type"),
        "method_type": lambda: in_domain(F.col("method_type"), "method_type"),
        "confidence": lambda: between_0_and_1(F.col("confidence")),
        "alternative_labels": lambda: F.forall("alternative_labels", lambda a: between_0_and_1(a["confidence"])),
    },
    "candidate": {
        **{c: (lambda c: lambda: not_blank(F.col(c)))(c) for c in ("target_row_id", "requirement_id", "capability_id")},
        "confidence": lambda: between_0_and_1(F.col("confidence")),
    },
    "index_node": {"node_id": lambda: not_blank(F.col("node_id")), "node_type": lambda: in_domain(F.col("node_type"), "node_type")},
    "model_call": {c: (lambda c: lambda: F.col(c) >= 0)(c) for c in ("input_tokens", "output_tokens", "cached_tokens")},
    "retrieval": {c: (lambda c: lambda: F.col(c) >= 0)(c) for c in ("candidate_count", "selected_count")},
    "stage_timing": {"duration_ms": lambda: F.col("duration_ms") >= 0},
}


def record_violations(df: DataFrame, key: str, record: str) -> DataFrame:
    """(key, check) for each check of a kind of record that a row breaks."""
    return violations(df, key, {name: check() for name, check in RECORD_CHECKS[record].items()})


class Capability(ABC):
    """An extraction capability: it maps evidence bundles to candidate values, both as DataFrames."""

    capability_id: str
    version: str
    supported_evidence_types: frozenset[str] = frozenset()
    supported_field_semantics: frozenset[str] = frozenset()
    input_requirements: frozenset[str] = frozenset()
    output_schema: str = CANDIDATE
    confidence_approach: str = ""
    rejection_rules: tuple[str, ...] = ()
    validation_requirements: tuple[str, ...] = ()

    @abstractmethod
    def extract(self, bundles: DataFrame) -> DataFrame:
        """Candidates of ``bundles``, in the columns of ``output_schema`` or some of them."""
