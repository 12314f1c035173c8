"""CSV records read range by range against the csv module, whatever the ranges cut."""

import csv
import io
import random

import pytest

from packloom.plans import dictionaries
from packloom.sources import records
from packloom.sources.sheets import SheetError, sheet_rows


def whole(raw: bytes) -> list[list[str]]:
    csv.field_size_limit(records.CELL_LIMIT)
    return list(csv.reader(io.StringIO(raw.decode("utf-8-sig"), newline="")))


def by_ranges(raw: bytes, size: int) -> list[list[str]]:
    """What the tasks do, one after the other."""
    stream, found = io.BytesIO(raw), []
    for at in range(0, len(raw), size):
        begin, end = records.cut_after(stream, at, len(raw)), records.cut_after(stream, at + size, len(raw))
        row = {"part": "p", "begin": begin, "end": end}
        if begin < end:
            for k in (0, 1):
                row[f"records{k}"], row[f"inside{k}"] = records._counted(records._lines(stream, begin, end), bool(k))
        found.append(row)
    out = []
    for task in records.settled(found):
        task = dict(zip((c.split()[0] for c in records.TASK.split(", ")), task))
        assert task["first"] == len(out) + 1
        out += (mine := list(records._parsed(task, stream)))
        assert len(mine) == task["records"]
    return out


def test_any_bytes_in_any_ranges():
    rnd = random.Random(1)
    pieces = ['"', '"', ",", "\n", "\r", "\r\n", "a", "é", '""', '\n"', '",', "﻿", " ", "\x0b"]
    for _ in range(3000):
        raw = "".join(rnd.choice(pieces) for _ in range(rnd.randrange(60))).encode()
        for size in (1, 2, 3, 7, 16):
            assert by_ranges(raw, size) == whole(raw), (raw, size)


def test_a_record_over_many_ranges():
    raw = ("h1,h2\n" + "x,y\n" * 5 + '"' + "line\r\nof a long cell\n" * 40 + '",end\n\n\nlast,"one"').encode()
    assert by_ranges(raw, 16) == whole(raw) and len(whole(raw)) == 10


@pytest.mark.parametrize("size", [64, 1000, records.RANGE_BYTES])
def test_file_and_folder(spark, tmp_path, size):
    rnd = random.Random(2)
    cell = lambda: rnd.choice(["plain", 'with "quotes"', "two\nlines", "a\r\nb", "", "é,ö"]) + str(rnd.randrange(99))
    rows = [[cell() for _ in range(rnd.randrange(1, 5))] if rnd.random() > 0.1 else [] for _ in range(400)]
    out = io.StringIO(newline="")
    csv.writer(out).writerows(rows)
    (tmp_path / "d.csv").write_bytes(out.getvalue().encode())
    found = sheet_rows(spark, str(tmp_path / "d.csv"), range_bytes=size)
    assert [(r.row_number, r.cells, r.types) for r in found.orderBy("row_number").collect()] == [(i, r, ["str"] * len(r)) for i, r in enumerate(rows, 1)]
    if size == 64:
        assert found.rdd.getNumPartitions() > 4
    folder = tmp_path / "parts.csv"
    folder.mkdir()
    for k in range(3):
        out = io.StringIO(newline="")
        csv.writer(out).writerows(rows[150 * k : 150 * k + 150])
        (folder / f"part-{k}.csv").write_bytes(out.getvalue().encode())
    (folder / "_SUCCESS").touch()
    (folder / "part-9.csv").touch()
    found = sheet_rows(spark, str(folder), range_bytes=size)
    assert [(r.row_number, r.cells) for r in found.orderBy("row_number").collect()] == list(enumerate(rows, 1))


def test_long_cells_and_bad_bytes(spark, tmp_path):
    (tmp_path / "long.csv").write_text("Field Name,Definition\nA," + "x" * 200_000 + "\n")
    assert [len(r.cells[1]) for r in sheet_rows(spark, str(tmp_path / "long.csv"), range_bytes=1 << 16).orderBy("row_number").collect()] == [10, 200_000]
    (tmp_path / "bad.csv").write_bytes(b"a,b\n\xff\xfe,c\n")
    with pytest.raises(SheetError, match="UTF-8"):
        dictionaries.ingest_dictionary(spark, str(tmp_path / "bad.csv"))
    (tmp_path / "none.csv").touch()
    with pytest.raises(SheetError, match="outside"):
        dictionaries.inspect_dictionary(spark, str(tmp_path / "none.csv"))
