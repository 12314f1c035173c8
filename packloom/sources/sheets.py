"""Rows of a CSV file or of a workbook's sheet, with their physical numbers and the types of their cells.

CSV rows are records (a quoted cell may span lines); empty lines are rows; they are read by many tasks, see ``records``. Workbooks are read as OOXML with the standard library:
cached values of formulas, shared and inline strings, numbers, booleans; numbers in date formats become moments, times of day or durations. A sheet is read row by row, and its shared strings are held.
"""

from __future__ import annotations

import csv
import io
import math
import re
import zipfile
from collections.abc import Iterator
from datetime import date, datetime, time, timedelta
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader

from packloom.ship import ship
from packloom.sources.records import CELL_LIMIT, RANGE_BYTES, csv_records
from packloom.sources.shared import filesystem

SCHEMA = "row_number int, cells array<string>, types array<string>"
_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


# Fixed values of the workbook format: built-in number formats that are dates or times, the one of them that is a duration, and the two calendars' day 0.
DATE_FORMATS = (14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47)
DURATION_FORMAT = 46
DAY_0, DAY_0_OF_1904 = datetime(1899, 12, 30), datetime(1904, 1, 1)
#: What of a format code isn't a placeholder: quoted text, escaped signs, padding, and brackets but those of hours, minutes and seconds.
_LITERAL = re.compile(r'"[^"]*"|\\.|_.|\*.|\[(?!(?:h+|m+|s+)\])[^\]]*\]', re.IGNORECASE)


class SheetError(ValueError):
    """The file isn't a dictionary that can be read, or lacks the sheet or header row."""


def sheet_names(content) -> list[str]:
    """Names of the sheets of a workbook, given as bytes or as a seekable stream."""
    try:
        with zipfile.ZipFile(io.BytesIO(content) if isinstance(content, bytes) else content) as z:
            book = ElementTree.fromstring(z.read("xl/workbook.xml"))
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError, OSError) as e:
        raise SheetError(f"not a workbook: {e}") from e
    return [s.get("name") or "" for s in book.iter(f"{_NS}sheet")]


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{_NS}t"))


def _column(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]*", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def format_kind(code: str) -> str | None:
    """Whether a number format shows a date or time, a duration (its first placeholder is in brackets), or neither."""
    shown = _LITERAL.sub("", code.split(";")[0]).lower()
    if re.match(r"\[(h+|m+|s+)\]", shown):
        return "duration"
    return "date" if re.search("[dmhys]", shown) else None


def _date_styles(z: zipfile.ZipFile) -> dict[str, str]:
    """The kinds of a workbook's cell styles that aren't plain numbers, by the styles' numbers."""
    if "xl/styles.xml" not in z.namelist():
        return {}
    styles = ElementTree.fromstring(z.read("xl/styles.xml"))
    kinds = {str(i): "duration" if i == DURATION_FORMAT else "date" for i in DATE_FORMATS}
    kinds |= {f.get("numFmtId"): format_kind(f.get("formatCode") or "") for f in styles.iter(f"{_NS}numFmt")}
    formats = styles.find(f"{_NS}cellXfs")
    found = {str(i): kinds.get(xf.get("numFmtId") or "0") for i, xf in enumerate(() if formats is None else formats)}
    return {k: v for k, v in found.items() if v}


def moment(serial: float, kind: str, day_0: datetime) -> datetime | time | timedelta | str:
    """A serial number of days as a duration, a time of day (below 1) or a moment, to the millisecond; the 1900 calendar has a 29 February too many. What no calendar has is the format's error text."""
    try:
        days = math.floor(serial)
        clock = timedelta(milliseconds=round((serial - days) * 86_400_000))
        if kind == "duration":
            return timedelta(days=days) + clock
        if days == 0 and clock < timedelta(days=1):
            return (datetime.min + clock).time()
        return day_0 + timedelta(days=days + (day_0 == DAY_0 and 0 < serial < 60)) + clock
    except (OverflowError, ValueError):
        return "#VALUE!"


def _iso(text: str) -> datetime | date | time | str:
    """A cell of ISO 8601 text; what isn't such stays text."""
    for kind in (date, time, datetime) if "T" not in text else (datetime,):
        try:
            return kind.fromisoformat(text)
        except ValueError:
            continue
    return text


def _strings(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    found = []
    with z.open("xl/sharedStrings.xml") as part:
        for _, node in ElementTree.iterparse(part):
            if node.tag == f"{_NS}si":
                found.append(_text(node))
                node.clear()
    return found


def workbook_rows(content: bytes, sheet: str | None = None) -> Iterator[list]:
    """Rows of a sheet (the first by default) as Python values; rows that the sheet leaves out are empty."""
    names = sheet_names(content)
    if sheet is not None and sheet not in names:
        raise SheetError(f"no worksheet {sheet!r}; there are {names}")
    if not names:
        raise SheetError("a workbook without sheets")
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        rid = [s.get(_REL) for s in book.iter(f"{_NS}sheet")][names.index(sheet) if sheet is not None else 0]
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        target = links.get(rid) or "worksheets/sheet1.xml"
        shared, dated, rows, last = _strings(z), _date_styles(z), None, 0
        setup = book.find(f"{_NS}workbookPr")
        day_0 = DAY_0_OF_1904 if setup is not None and setup.get("date1904") in ("1", "true") else DAY_0
        with z.open(target.lstrip("/") if target.startswith("/") else f"xl/{target}") as part:
            for event, node in ElementTree.iterparse(part, ("start", "end")):
                if event == "start" and node.tag == f"{_NS}sheetData":
                    rows = node
                if event == "start" or node.tag != f"{_NS}row":
                    continue
                number = int(node.get("r") or last + 1)
                for _ in range(last + 1, number):
                    yield []
                last, row = number, []
                for cell in node.iter(f"{_NS}c"):
                    at = _column(cell.get("r") or "") if cell.get("r") else len(row)
                    row += [None] * (at - len(row))
                    kind, value = cell.get("t"), cell.findtext(f"{_NS}v")
                    if kind == "inlineStr":
                        value = _text(cell)
                    elif value is None:
                        pass
                    elif kind == "s":
                        value = shared[int(value)]
                    elif kind == "b":
                        value = value == "1"
                    elif kind in (None, "n"):
                        value = float(value) if re.search(r"[.eE]", value) else int(value)
                        if cell.get("s") in dated:
                            value = moment(value, dated[cell.get("s")], day_0)
                    elif kind == "d":
                        value = _iso(value)
                    row.append(value)
                yield row
                if rows is not None:  # rows that have been read are let go
                    rows.clear()


def csv_rows(stream) -> Iterator[list]:
    """Records of a byte stream, read as it goes."""
    csv.field_size_limit(CELL_LIMIT)
    try:
        yield from csv.reader(io.TextIOWrapper(stream, "utf-8-sig", newline=""))
    except (UnicodeDecodeError, csv.Error) as e:
        raise SheetError(f"not a CSV file in UTF-8: {e}") from e


def file_rows(path: str, sheet: str | None) -> Iterator[list]:
    """Rows of a dictionary file: of a CSV file one after the other, of a workbook from its sheet."""
    suffix = path.rsplit(".", 1)[-1].lower()
    if suffix not in ("csv", "xlsx"):
        raise SheetError(f"neither a CSV file nor a workbook: {path}")
    if suffix == "xlsx":
        yield from workbook_rows(_read(path), sheet)
        return
    where, name = filesystem(path)
    with where.open_input_file(name) as stream:
        yield from csv_rows(stream)


def _read(path: str) -> bytes:
    where, name = filesystem(path)
    with where.open_input_stream(name, compression=None) as stream:
        return stream.read()


class SheetSource(DataSourceReader):
    """What readers of dictionary files share: physical rows as (row_number, cells, types); ``inspect`` reads the same rows as ``read``."""

    def __init__(self, path: str, sheet: str | None):
        self.path, self.sheet = path, sheet

    def inspect(self) -> Iterator[tuple]:
        return self.read(None)


class SheetReader(SheetSource):
    def read(self, partition) -> Iterator[tuple]:
        for i, row in enumerate(file_rows(self.path, self.sheet), 1):
            yield i, [None if v is None else v if isinstance(v, str) else str(v) for v in row], [None if v is None else type(v).__name__ for v in row]


class SheetRows(DataSource):
    """``spark.read.format("sheet_rows").option("sheet", name).load(path)``: every physical row, header included."""

    @classmethod
    def name(cls) -> str:
        return "sheet_rows"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> SheetReader:
        return SheetReader(self.options["path"], self.options.get("sheet"))


def sheet_rows(spark: SparkSession, path: str, sheet: str | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Every physical row (row_number, cells, types). A CSV file, or a folder of its parts, is read in ranges of ``range_bytes``; a workbook by one task, whose rows are dealt out at once."""
    ship(spark)
    if path.lower().rstrip("/").endswith(".csv"):
        try:
            return csv_records(spark, path, range_bytes)
        except ValueError as e:
            raise SheetError(f"not a CSV file in UTF-8: {e}") from e
    spark.dataSource.register(SheetRows)
    reader = spark.read.format("sheet_rows")
    rows = (reader.option("sheet", sheet) if sheet is not None else reader).load(path)
    return rows.repartition(spark.sparkContext.defaultParallelism, "row_number")


def sheets_of(path: str) -> list[str]:
    """Names of a workbook's sheets; none for other files."""
    return sheet_names(_read(path)) if path.lower().endswith(".xlsx") else []
