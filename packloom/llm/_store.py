"""Shared scratch space: tables and files that every executor and the driver can read."""

from __future__ import annotations

import contextlib
import functools
from collections.abc import Callable, Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packloom.sources.shared import make_dir, open_read, open_write, remove_dir, scratch, shared_dir, written

__all__ = ["alone", "cut", "freed", "fresh", "keyed", "make_dir", "open_read", "open_write", "remove_dir", "scratch", "shared_dir", "table"]
_SCOPE: ContextVar[list[str] | None] = ContextVar("scope", default=None)


@contextlib.contextmanager
def freed() -> Iterator[None]:
    """Delete the tables written within: for callers whose results don't read them afterwards."""
    folders: list[str] = []
    token = _SCOPE.set(folders)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for folder in folders:
            remove_dir(folder)


def _claim(folder: str) -> None:
    if (folders := _SCOPE.get()) is not None:
        folders.append(folder)


def table(df: DataFrame, kind: str) -> tuple[DataFrame, str]:
    """``df`` computed once, as a written table in the shared folder, and that folder. It stays until its scope of ``freed`` ends; outside of one, until the shared folder is cleared."""
    folder = scratch(df.sparkSession, kind)
    _claim(folder)
    return written(df, folder), folder


def alone(make: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For a function whose result is small: it is computed and kept as one table, and all tables that it was made of are deleted."""

    @functools.wraps(make)
    def made(*args, **how) -> DataFrame:
        with freed():
            df = make(*args, **how)
            folder = scratch(df.sparkSession, make.__name__)
            out = written(df, folder)
        _claim(folder)
        return out

    return made


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder: later steps survive the loss of executors, start from a short plan and know the table's size."""
    return table(df, "cut")[0]


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` as a written table of ``__row``, a key that doesn't change, and ``doc``, a struct of all its columns (their names clash with nothing)."""
    return table(docs.select(F.monotonically_increasing_id().alias("__row"), F.struct("*").alias("doc")), "docs")[0]
