"""Columns that later steps read are computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with more columns (or new ones of a name), each computed once: what is read or filtered later isn't pushed below a generator, nor spelled out in its place."""
    fields = [F.col(f"`{c}`").alias(c) for c in df.columns if c not in columns] + [v.alias(k) for k, v in columns.items()]
    return df.select(F.inline(F.array(F.struct(*fields))))
