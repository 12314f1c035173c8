"""A total order over a table: positions and running sums without a single-task window."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from packloom.llm._store import shared_dir, table


def ranked(df: DataFrame, order: list[str], value: str, pos: str = "pos", before: str = "before") -> DataFrame:
    """``df`` in ascending order (nulls first) with each row's position from 0 and the sum of ``value`` over the rows before it.

    Rows are range-partitioned and kept in the shared folder; the driver sees one total a partition.
    """
    shared_dir(df.sparkSession)
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()).checkpoint()  # keeps partitions and their order
    totals = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("v")).collect()
    at, starts = (0, 0), {}
    for r in sorted(totals, key=lambda r: r["__part"]):
        starts[r["__part"]] = at
        at = (at[0] + r.n, at[1] + r.v)
    starts = df.sparkSession.sparkContext.broadcast(starts)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if now is None:
                now = starts.value[batch.column("__part")[0].as_py()]
            v = np.asarray(batch.column(value)).astype(np.int64)
            run = np.cumsum(v)
            batch = batch.append_column(pos, pa.array(now[0] + np.arange(len(v)))).append_column(before, pa.array(now[1] + run - v))
            now = (now[0] + len(v), now[1] + int(run[-1]))
            yield batch

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + f", {pos} long, {before} long"
    return rows.mapInArrow(number, schema).drop("__part")


def running(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` with the sum of each expression over the rows before, by DataFrame functions alone: rows are range-partitioned and written; one row a partition is ordered in one task."""
    rows = table(df.repartitionByRange(*order).withColumns({"__part": F.spark_partition_id()} | {f"__v_{k}": v.cast("long") for k, v in sums.items()}), "ordered")[0]
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    parts = rows.groupBy("__part").agg(*[F.sum(f"__v_{k}").alias(f"__s_{k}") for k in sums])
    parts = parts.select("__part", *[F.coalesce(F.sum(f"__s_{k}").over(before), F.lit(0)).alias(f"__b_{k}") for k in sums])
    inner = W.partitionBy("__part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    out = rows.join(parts, "__part").withColumns({k: F.coalesce(F.sum(f"__v_{k}").over(inner), F.lit(0)) + F.col(f"__b_{k}") for k in sums})
    return out.select(*df.columns, *sums)
