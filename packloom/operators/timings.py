"""Times of a run: of its stages, measured by the driver around each action, and of its files, measured where they are read."""

from __future__ import annotations

import contextlib
import sys
import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The stages of a pack, and those of a dictionary.
PACK_STAGES = ("discovery_ms", "hashing_ms", "archive_ms", "metadata_ms", "classification_ms", "duplicate_detection_ms", "artifact_writing_ms")
DICTIONARY_STAGES = ("file_read_ms", "worksheet_read_ms", "normalization_ms", "validation_ms", "artifact_writing_ms")


class Clock:
    """Sums the milliseconds of stages by name, and tells ``progress`` of each as it begins."""

    def __init__(self, progress: Callable[[str, str], None] | None = None, stages: tuple[str, ...] = PACK_STAGES):
        self.total, self.progress = dict.fromkeys(stages, 0.0), progress

    @contextlib.contextmanager
    def __call__(self, stage: str, subject: str = "") -> Iterator[None]:
        if self.progress:
            self.progress(stage.removesuffix("_ms"), subject)
        start = time.perf_counter()
        try:
            yield
        finally:
            self.total[stage] += (time.perf_counter() - start) * 1000


def to_stderr(stage: str, subject: str) -> None:
    print(f"[{stage}] {subject}", file=sys.stderr, flush=True)


def shared_out(total_ms: float, sources: DataFrame) -> DataFrame:
    """(source_id, classification_ms): a stage that is one expression over all sources took the same time for each."""
    n = max(1, sources.count())
    return sources.select("source_id", F.lit(total_ms / n).alias("classification_ms"))


def file_timings(found: DataFrame, sources: DataFrame, archives: DataFrame, members: DataFrame, durations: DataFrame) -> DataFrame:
    """One row a discovered file: relative_path, file_size, detected_type, six times, status. What a file has no time of counts as 0.

    Types are told by the read that also hashes, so that only files that are merely sniffed have a time of their own for that.
    Sources meet their files by logical path, and durations their sources by id.
    """
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    own = sources.where("archive_depth = 0").join(durations, "source_id", "left")
    inside = members.groupBy("archive").agg(F.sum("duration_ms").alias("members_ms"))
    took = archives.select(F.col("archive").alias("source_id"), "duration_ms").join(inside.withColumnRenamed("archive", "source_id"), "source_id", "left")
    own = own.join(took, "source_id", "left").select(F.col("logical_path").alias("relative_path"), "metadata_ms", "classification_ms", (zero("duration_ms") + zero("members_ms")).alias("archive_ms"), "extraction_status")
    rows = found.join(own, "relative_path", "left")
    parts = {"file_type_detection_ms": zero("sniff_ms"), "hashing_duration_ms": zero("hash_ms"), "metadata_inspection_ms": zero("metadata_ms"), "classification_ms": zero("classification_ms"), "archive_duration_ms": zero("archive_ms")}
    rows = rows.select("relative_path", F.col("size_bytes").alias("file_size"), "detected_type", *[v.alias(k) for k, v in parts.items()], F.coalesce("extraction_status", "disposition").alias("status"))
    return rows.withColumn("total_duration_ms", sum((F.col(k) for k in parts), F.lit(0.0)))


def stage_totals(times: DataFrame) -> DataFrame:
    """(stage, duration_ms) rows to one row a stage: their sum and number."""
    return times.groupBy("stage").agg(F.sum("duration_ms").alias("duration_ms"), F.count(F.lit(1)).alias("n"))
