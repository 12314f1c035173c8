"""Sources as a stream: files that arrive are registered, classified and counted as they do, by the same expressions as in a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packloom.functions import files, ids
from packloom.functions.barrier import held
from packloom.operators import classify

#: What arrives: a file's path below the pack, its bytes, and when it came.
ARRIVED = "logical_path string, content binary, arrived timestamp"


def arrivals(spark: SparkSession, folder: str, files_a_batch: int = 1000) -> DataFrame:
    """A stream of the rows of Parquet files that come to ``folder``."""
    return spark.readStream.schema(ARRIVED).option("maxFilesPerTrigger", files_a_batch).parquet(folder)


def registered(arrived: DataFrame) -> DataFrame:
    """Arrived files (a stream or a batch) with type, hash, id, disposition and label; no state is kept."""
    name = files.file_name(F.col("logical_path"))
    rows = held(arrived, {"file_type": files.file_type(F.col("content"), name), "file_hash": F.sha2("content", 256), "size_bytes": F.length("content").cast("bigint")})
    return rows.select(
        "arrived",
        "logical_path",
        "file_type",
        "file_hash",
        "size_bytes",
        ids.source_id("file_hash", "logical_path").alias("source_id"),
        files.disposition(name, F.col("file_type")).alias("disposition"),
        classify.label_of(F.col("file_type"), F.col("logical_path"))["primary_label"].alias("classification"),
    )


def first_copies(rows: DataFrame, late: str = "1 day") -> DataFrame:
    """Registered files without those whose content and path came before, as far back as ``late``; state is kept so long."""
    return rows.withWatermark("arrived", late).dropDuplicatesWithinWatermark(["source_id"])


def counts(rows: DataFrame, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Files and bytes by window and label. A window's counts are final once ``late`` has passed; files that come later don't count."""
    by = rows.withWatermark("arrived", late).groupBy(F.window("arrived", window).alias("w"), "classification")
    out = by.agg(F.count(F.lit(1)).alias("n_files"), F.sum("size_bytes").alias("bytes"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "classification", "n_files", "bytes")
