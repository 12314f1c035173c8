"""Archive members: safety checks, the greedy bound on their sum, and counters by archive."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ArchiveLimits:
    """Bounds on what an archive may hold; the defaults are fixed values."""

    max_depth: int = 2
    max_member_count: int = 500
    max_uncompressed_bytes: int = 500_000_000
    max_member_bytes: int = 100_000_000
    max_compression_ratio: float = 100.0


def _codes(e: Column, repeats: Column, limits: ArchiveLimits) -> Column:
    """Issue codes of an entry in order, but for the bound on the sum."""
    size, packed = e["uncompressed_size"], e["compressed_size"]
    ratio = F.when(packed != 0, size / packed).otherwise(size.cast("double"))
    checks = [
        (e["member_path"].startswith("/"), "ARCHIVE_ABSOLUTE_PATH"),
        (F.array_contains(F.split(e["member_path"], "/"), ".."), "ARCHIVE_PATH_TRAVERSAL"),
        (repeats, "ARCHIVE_DUPLICATE_MEMBER"),
        (e["encrypted"], "ARCHIVE_ENCRYPTED_MEMBER"),
        (size > limits.max_member_bytes, "ARCHIVE_MEMBER_SIZE_LIMIT"),
        (ratio > limits.max_compression_ratio, "ARCHIVE_COMPRESSION_RATIO_LIMIT"),
    ]
    return F.array_compact(F.array(*[F.when(c, code) for c, code in checks]))


def check_members(members: DataFrame, limits: ArchiveLimits = ArchiveLimits()) -> DataFrame:
    """``members`` (archive, idx, member_path, is_dir, encrypted, compressed_size, uncompressed_size and further narrow columns) with issue codes in order, and status.

    Only the first ``max_member_count`` entries of an archive count. An entry repeats another if its path came before it, rejected
    entries included. The bound on the sum is greedy: an entry that would pass it is rejected and adds nothing, so that later, smaller
    ones may fit; entries that fail another check and directories add nothing either. One shuffle brings an archive's entries together, a bounded
    array, through which one pass goes.
    """
    m = members.where(F.col("idx") < limits.max_member_count).withColumn("member_path", F.replace("member_path", F.lit("\\"), F.lit("/")))
    names = [c for c in m.columns if c != "archive"]
    entries = m.groupBy("archive").agg(F.array_sort(F.collect_list(F.struct("idx", *[c for c in names if c != "idx"]))).alias("e"))
    entries = entries.select("archive", "e", F.transform("e", lambda x: x["member_path"]).alias("paths"))
    checked = F.transform("e", lambda x, i: F.struct(x.alias("x"), _codes(x, F.array_position("paths", x["member_path"]) <= i, limits).alias("codes")))
    entries = entries.select("archive", F.inline(F.array(F.struct(checked.alias("c")))))
    most = F.lit(limits.max_uncompressed_bytes).cast("bigint")

    def step(acc, c):
        size = c["x"]["uncompressed_size"].cast("bigint")
        over = acc["sum"] + size > most
        adds = (F.size(c["codes"]) == 0) & ~c["x"]["is_dir"] & ~over
        return F.struct(F.when(adds, acc["sum"] + size).otherwise(acc["sum"]).alias("sum"), F.concat(acc["over"], F.array(over)).alias("over"))

    start = F.struct(F.lit(0).cast("bigint").alias("sum"), F.array().cast("array<boolean>").alias("over"))
    rows = entries.select("archive", F.inline(F.arrays_zip("c", F.aggregate("c", start, step)["over"].alias("over"))))
    issues = F.when(F.col("over"), F.concat("c.codes", F.array(F.lit("ARCHIVE_UNCOMPRESSED_LIMIT")))).otherwise(F.col("c.codes"))
    rows = rows.select("archive", *[F.col(f"c.x.{n}").alias(n) for n in names], issues.alias("issues"))
    status = F.when(F.size("issues") > 0, "rejected").when(F.col("is_dir"), "ignored").otherwise("registered")
    return rows.withColumn("status", status)


def archive_summaries(checked: DataFrame, total: DataFrame | None = None, limits: ArchiveLimits = ArchiveLimits()) -> DataFrame:
    """Counters by archive; ``total`` (archive, entries) tells which archives have more entries than count. Members that passed the checks add their bytes even if their extraction failed."""
    passed = (F.col("status") == "registered") | F.array_contains("issues", "ARCHIVE_EXTRACTION_FAILED")
    out = checked.groupBy("archive").agg(
        F.count(F.lit(1)).alias("member_count"),
        F.count_if(F.col("status") == "registered").alias("extracted_count"),
        F.count_if(F.col("status") == "rejected").alias("rejected_count"),
        F.count_if(F.col("status") == "ignored").alias("ignored_count"),
        F.coalesce(F.sum(F.when(passed, F.col("uncompressed_size"))), F.lit(0)).cast("bigint").alias("total_uncompressed_bytes"),
    )
    if total is None:
        return out
    return out.join(total, "archive").withColumn("over_member_limit", F.col("entries") > limits.max_member_count).drop("entries")


def warnings_by_code(checked: DataFrame) -> DataFrame:
    return checked.select(F.explode("issues").alias("issue_code")).groupBy("issue_code").agg(F.count(F.lit(1)).alias("n"))
