"""Records of CSV files read by many tasks, with their physical numbers.

A file is cut into byte ranges that begin behind a line break. There, a record either begins or a quoted cell goes on, whatever came before; tasks
parse each range under both starts and tell how many records begin in it and how it ends. A scan over the ranges, in order, settles which start holds and what
number its first record has. Then tasks parse their ranges alone: a record that runs over a range's end is read on from the next ones by the task in whose range it began.

A dictionary may be one file or a folder of part files as Spark writes them; parts follow each other by name, and a record ends with its part.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from packloom.ship import ship
from packloom.sources.shared import filesystem

RANGE_BYTES = 8 << 20
BLOCK = 1 << 16
#: A cell may be as long as a text can be.
CELL_LIMIT = 2**31 - 1
PLAN = "part string, begin long, end long"
FOUND = f"{PLAN}, records0 long, inside0 boolean, records1 long, inside1 boolean, error string"
TASK = f"{PLAN}, size long, inside boolean, first long, records long"
ROWS = "row_number int, cells array<string>, types array<string>"
#: A line behind a range: two cells, unless a quoted cell goes on.
_MARK = ["\x00end", "of range\x00"]


def part_files(path: str) -> list[tuple[str, int]]:
    """The file, or the part files of a folder by name, with their sizes. Names that begin with a dot or an underscore are not parts."""
    from pyarrow import fs

    where, name = filesystem(path)
    info = where.get_file_info(name)
    if info.type != fs.FileType.Directory:
        return [(path, info.size)] if info.type == fs.FileType.File else []
    found = [f for f in where.get_file_info(fs.FileSelector(name)) if f.type == fs.FileType.File and not f.base_name.startswith((".", "_"))]
    return [(f"{path.rstrip('/')}/{f.base_name}", f.size) for f in sorted(found, key=lambda f: f.base_name)]


def cut_after(stream, at: int, size: int) -> int:
    """Where the first line break at or behind the byte before ``at`` ends; 0 is a cut, the file's end one if none follows."""
    if at <= 0 or at >= size:
        return max(0, min(at, size))
    stream.seek(at - 1)
    at -= 1
    while block := stream.read(BLOCK):
        places = [p for p in (block.find(b"\n"), block.find(b"\r")) if p >= 0]
        if places:
            at += min(places) + 1
            if block[min(places)] == 13:  # with a line feed it is one break
                stream.seek(at)
                at += stream.read(1) == b"\n"
            return at
        at += len(block)
    return size


def _lines(stream, begin: int, end: int) -> io.StringIO:
    stream.seek(begin)
    return io.StringIO(stream.read(end - begin).decode("utf-8-sig" if begin == 0 else "utf-8"), newline="")


def _reader(lines) -> Iterator[list]:
    csv.field_size_limit(CELL_LIMIT)
    return csv.reader(lines)


def _counted(lines: io.StringIO, inside: bool) -> tuple[int, bool]:
    """Records that begin in a range whose start is ``inside`` a quoted cell or not, and whether its end is inside one."""

    def fed() -> Iterator[str]:
        yield from lines
        yield ",".join(_MARK)

    source = fed()
    if inside:
        source = _quoted(source)
    n, last = 0, None
    for last in _reader(source):
        n += 1
    ends_inside = last != _MARK
    return n - (not ends_inside) - inside, ends_inside  # the mark is no record; one that goes on from before began there


def _quoted(lines: Iterator[str]) -> Iterator[str]:
    """The lines as they are read inside a quoted cell."""
    yield '"' + next(lines)
    yield from lines


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            where, name = filesystem(r["part"])
            with where.open_input_file(name) as stream:
                begin, end = (cut_after(stream, r[k], r["size"]) for k in ("begin", "end"))
                row = {"part": r["part"], "begin": begin, "end": end}
                if begin < end:
                    try:
                        lines = _lines(stream, begin, end)
                        row["records0"], row["inside0"] = _counted(lines, False)
                        lines.seek(0)
                        row["records1"], row["inside1"] = _counted(lines, True)
                    except (UnicodeDecodeError, csv.Error) as e:
                        row["error"] = str(e)[:200]
                out.append(row)
        kinds = [("part", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("records0", pa.int64()), ("inside0", pa.bool_()), ("records1", pa.int64()), ("inside1", pa.bool_()), ("error", pa.string())]
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema(kinds))


def settled(found: list[dict]) -> list[tuple]:
    """Of the ranges in order, TASK rows: how each begins, the number of its first record (from 1) and how many begin in it."""
    out, number, inside, part = [], 1, False, None
    sizes: dict[str, int] = {}
    for r in found:
        sizes[r["part"]] = max(sizes.get(r["part"], 0), r["end"])
    for r in found:
        if r["part"] != part:
            part, inside = r["part"], False
        if r["begin"] >= r["end"]:
            continue
        records, ends = (r["records1"], r["inside1"]) if inside else (r["records0"], r["inside0"])
        if records:
            out.append((part, r["begin"], r["end"], sizes[part], inside, number, records))
            number += records
        inside = ends
    return out


def _parsed(task: dict, stream) -> Iterator[list]:
    """The records that begin in a range; the last one is read to its end, however far."""

    def lines() -> Iterator[str]:
        begin, end = task["begin"], task["end"]
        while begin < task["size"]:
            yield from _lines(stream, begin, end)
            begin, end = end, cut_after(stream, end + (task["end"] - task["begin"]), task["size"])

    source = _quoted(lines()) if task["inside"] else lines()
    return islice(_reader(source), int(task["inside"]), int(task["inside"]) + task["records"])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.string())
    for batch in batches:
        for task in batch.to_pylist():
            where, name = filesystem(task["part"])
            with where.open_input_file(name) as stream:
                held, size, number = [], 0, task["first"]
                for record in _parsed(task, stream):
                    held.append(record)
                    size += sum(map(len, record)) + 64
                    if size > 4 << 20:
                        yield _rows(held, number, kind)
                        number, held, size = number + len(held), [], 0
                if held:
                    yield _rows(held, number, kind)


def _rows(records: list[list], number: int, kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(range(number, number + len(records)), pa.int32()), pa.array(records, kind), pa.array([["str"] * len(r) for r in records], kind)], names=["row_number", "cells", "types"])


def csv_ranges(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> list[tuple]:
    """The settled ranges (TASK rows) of a CSV file or a folder of such; ValueError if its bytes aren't UTF-8. The driver holds one row a range."""
    ship(spark)
    plan = [(name, at, at + range_bytes, size) for name, size in part_files(path) for at in range(0, size, range_bytes)]
    if not plan:
        return []
    tasks = spark.sparkContext.parallelize(plan, min(len(plan), 4 * spark.sparkContext.defaultParallelism))
    found = [r.asDict() for r in spark.createDataFrame(tasks, f"{PLAN}, size long").mapInArrow(_scan, FOUND).collect()]
    found.sort(key=lambda r: (r["part"], r["begin"], r["end"]))
    if bad := next((r["error"] for r in found if r["error"]), None):
        raise ValueError(bad)
    return settled(found)


def csv_records(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Every physical record as (row_number, cells, types); an empty line is a record without cells. Ranges are read by as many tasks as there are, or as there are cores four times over."""
    tasks = csv_ranges(spark, path, range_bytes)
    if not tasks:
        return spark.createDataFrame([], ROWS)
    rows = spark.sparkContext.parallelize(tasks, min(len(tasks), 4 * spark.sparkContext.defaultParallelism))
    return spark.createDataFrame(rows, TASK).mapInArrow(_read, ROWS)
