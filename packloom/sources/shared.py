"""Shared scratch space: a folder that every executor and the driver can read, and tables and files in it."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from packloom.ship import ship

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset (local tests), a temporary one."""
    ship(spark)
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if sc.applicationId not in _OWN:
            _OWN[sc.applicationId] = tempfile.mkdtemp(prefix="packloom-")
            atexit.register(shutil.rmtree, _OWN[sc.applicationId], ignore_errors=True)
        found = _OWN[sc.applicationId]
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def scratch(spark: SparkSession, kind: str) -> str:
    """A new folder name below the shared folder."""
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def filesystem(uri: str):
    """The file system of a path or URI, and the path in it. Names are taken as they are: nothing in them is an escape."""
    from pyarrow import fs

    m = re.match(r"([a-z][a-z0-9+.-]*):(?://([^/]*))?(/.*)?$", uri, re.DOTALL)
    if not m or m[1] == "file":
        return fs.LocalFileSystem(), (m[3] or "/") if m else uri
    where, base = fs.FileSystem.from_uri(f"{m[1]}://{m[2] or ''}/")
    return where, base.rstrip("/") + (m[3] or "/")


def make_dir(uri: str) -> None:
    where, path = filesystem(uri)
    where.create_dir(path, recursive=True)


def open_write(uri: str):
    where, path = filesystem(uri)
    return where.open_output_stream(path, compression=None)


def open_read(uri: str):
    where, path = filesystem(uri)
    return where.open_input_file(path)


def remove_dir(uri: str) -> None:
    """Delete a scratch folder; one that is gone already is fine."""
    from pyarrow import fs

    where, path = filesystem(uri)
    if where.get_file_info(path).type == fs.FileType.Directory:
        where.delete_dir(path)


#: Shuffle files go as soon as the write that needed them has ended.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, folder: str) -> DataFrame:
    """``df`` computed once, as a table written to ``folder``: later steps survive the loss of executors, start from a short plan and know the table's size."""
    spark = df.sparkSession
    before = spark.conf.get(CLEAN, "false")
    spark.conf.set(CLEAN, "true")
    try:
        df.write.parquet(folder)
    finally:
        spark.conf.set(CLEAN, before)
    return spark.read.schema(df.schema).parquet(folder)
