import csv
import dataclasses
import datetime
import hashlib
import json
import os
import zipfile
from xml.sax.saxutils import escape

import pytest
from pyspark.sql import functions as F

from packloom.functions import text as T
from packloom.operators import dictionary as D
from packloom.plans import dictionaries, sinks
from packloom.sources.sheets import SheetError, sheet_rows, workbook_rows

HEADER = [a["aliases"][0] for a in D.TEMPLATE["columns"].values()]
ORDER = ["Field Name", "Data Requirement id", "Term Name", "Sub-Domain", "Field Label", "Business Definition", "Notes", *HEADER[7:9], "Multiple Records Possible (Y/N)", "Example"]
ROWS = [
    ["pump_total", "PX7", "Booster Pumps", "Plumbing", "Count", "Number of pumps on site", "e.g. Duty, Standby; matrix", "Pump", "Booster", "yes", None],
    [None] * 11,
    ["pump_maker", None, "Booster Pumps", "Plumbing", "Maker", "Who built it", None, "Pump", "Booster", None, None],
    [None, "PX9", None, "Plumbing", "Tag", None, None, "Pump", None, "perhaps", None],
]


def write_xlsx(path, sheets):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(path, "w") as z:
        names = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f"<workbook {main} {rel}><sheets>{names}</sheets></workbook>")
        links = "".join(f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        for i, rows in enumerate(sheets.values(), 1):
            body = ""
            for n, row in enumerate(rows, 1):
                cells = ""
                for c, v in enumerate(row):
                    ref = f"{chr(65 + c)}{n}"
                    if isinstance(v, bool):
                        cells += f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
                    elif isinstance(v, (int, float)):
                        cells += f'<c r="{ref}"><v>{v!r}</v></c>'
                    elif v is not None:
                        cells += f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>'
                body += f'<row r="{n}">{cells}</row>'
            z.writestr(f"xl/worksheets/sheet{i}.xml", f"<worksheet {main}><sheetData>{body}</sheetData></worksheet>")
    return str(path)


@pytest.fixture()
def book(tmp_path):
    return write_xlsx(tmp_path / "dict.xlsx", {"Extraction Template": [ORDER, *ROWS], "Other": [["a"]]})


def test_rows_keep_their_places_and_outcomes(spark, book):
    r = dictionaries.ingest_dictionary(spark, book)
    got = {x.row_number: x for x in r.results.collect()}
    assert {k: v.disposition for k, v in got.items()} == {2: "normalized", 3: "ignored_blank", 4: "normalized_with_warnings", 5: "rejected"}
    t = got[2].target
    assert (t.cardinality, t.expected_data_type, t.accepted_values, t.likely_evidence_types) == ("multiple", "integer", ["Duty", "Standby", "matrix"], ["table"])
    raw = "extraction_template|Extraction Template|2|PX7|pump_total"
    assert t.target_row_id == "trg_" + hashlib.sha256(raw.encode()).hexdigest()[:16]
    assert [i.issue_code for i in got[4].issues] == ["MISSING_REQUIREMENT_ID", "MISSING_CARDINALITY"]
    assert got[4].target.requirement_id == "row_4" and got[4].target.provenance.raw_requirement_id == ""
    assert [i.issue_code for i in got[5].issues] == ["BLANK_MANDATORY_COLUMN", "MISSING_DESCRIPTIVE_FIELD"] and got[5].target is None
    assert r.summary.first().asDict() == {
        "physical_rows": 4, "blank_rows": 1, "candidate_rows": 3, "normalized_rows": 2, "rows_with_warnings": 1, "rejected_rows": 1, "unique_ids": 2, "duplicate_ids": 0,
        "counts_by_sub_domain": {"Plumbing": 2}, "counts_by_expected_type": {"integer": 1, "string": 1}, "counts_by_likely_evidence_type": {"table": 1, "text": 1}, "unmapped_columns": [], "ambiguous_mappings": [],
    }
    assert all(i.suggested_action for x in got.values() for i in x.issues)
    assert set(r.timings) == {"file_read_ms", "worksheet_read_ms", "normalization_ms", "validation_ms", "artifact_writing_ms"} and r.timings["normalization_ms"] > 0
    assert r.duplicates.count() == 0


def test_identifiers_match_known_values(spark):
    row = spark.range(1)
    from packloom.functions import ids

    lit = F.lit
    got = row.select(
        ids.target_row_id(lit("dict"), lit("sheet"), lit(2), lit("DR1"), lit("door_count")).alias("a"),
        ids.target_row_id(lit("dict"), lit("sheet"), lit(3), lit("DR1"), lit("door_count")).alias("b"),
        ids.source_id(F.sha2(lit("same content").cast("binary"), 256), lit("a.txt")).alias("c"),
        ids.source_id(F.sha2(lit("same content").cast("binary"), 256), lit("b.txt")).alias("d"),
        ids.path_source_id(lit("a.txt"), F.sha2(lit("same content").cast("binary"), 256)).alias("e"),
        ids.classification_id(lit("src_94ec4f5d395e7a9f"), lit("unknown")).alias("f"),
    ).first()
    assert tuple(got) == ("trg_9a3f9be9a9421dd7", "trg_470d14d2f7ded155", "src_94ec4f5d395e7a9f", "src_c9727cfe0464796b", "src_b336348d3f0fd2d5", "cls_18a92e8690d49001")


def test_runs_agree_and_artifacts_are_written(spark, book, tmp_path):
    a, b = (sorted(x.target_row_id for x in dictionaries.ingest_dictionary(spark, book).targets.collect()) for _ in range(2))
    assert a == b
    result = dictionaries.ingest_dictionary(spark, book)
    paths = sinks.write_dictionary(result, str(tmp_path / "out"), single_file=True)
    assert len(paths) == 7
    manifest = json.load(open(paths["dictionary_manifest"]))
    assert manifest["output_paths"] == paths and manifest["timings"]["artifact_writing_ms"] > 0 and manifest["ingested_at"] and manifest["format"] == "xlsx"
    folders = sinks.write_dictionary(result, str(tmp_path / "folders"))
    assert sorted(r.target_row_id for r in spark.read.csv(folders["normalized_targets_csv"], header=True).collect()) == a
    assert len(list(csv.DictReader(open(paths["validation_issues_csv"])))) == 4
    lines = open(paths["normalized_targets_jsonl"]).read().splitlines()
    assert [json.loads(x)["expected_field"] for x in lines] == ["pump_total", "pump_maker"]
    assert open(paths["normalized_targets_csv"]).readline().startswith("target_row_id,requirement_id,sub_domain")
    assert "MISSING_CARDINALITY" in open(paths["validation_issues_csv"]).read()


def test_inspect_counts_trailing_blank_rows(spark, tmp_path):
    path = write_xlsx(tmp_path / "d.xlsx", {"Extraction Template": [[*ORDER, "", "Notes"], ROWS[0], ROWS[1]]})
    got = dictionaries.inspect_dictionary(spark, path)
    assert (got["physical_rows"], got["blank_rows"], got["sheet_names"]) == (2, 1, ["Extraction Template"])
    assert got["duplicate_or_blank_columns"] == ["", "Notes"] and got["columns"][-2:] == ["blank_column_12", "Notes__2"]
    with pytest.raises(SheetError):
        dictionaries.ingest_dictionary(spark, path, sheet="missing")
    with pytest.raises(SheetError):
        dictionaries.inspect_dictionary(spark, path, header_row=99)
    with pytest.raises(SheetError):
        dictionaries.inspect_dictionary(spark, str(tmp_path / "x.txt"))


def test_csv_rows_are_records(spark, tmp_path):
    path = tmp_path / "d.csv"
    lines = ["﻿" + ",".join(f'"{h}"' for h in ORDER), "field,DR1,Term,Domain,Label,,,,,N,", "", '"a\nb",DR2,Term,Domain,Label,,,,,N,,beyond']
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    r = dictionaries.ingest_dictionary(spark, str(path))
    got = {x.row_number: (x.disposition, x.target.expected_field if x.target else None) for x in r.results.collect()}
    assert got == {2: ("normalized", "field"), 3: ("ignored_blank", None), 4: ("normalized", "a b")}


def test_binding():
    assert D.header_key(" Data_Requirement  ID ") == "data requirement id"
    m = D.bind_columns({"columns": {"f": {"aliases": ["missing", "Field Name"]}, "g": {"aliases": ["A", "B"]}}}, ["Field Name", "B", "A", "rest"])
    assert m.fields == {"f": "Field Name", "g": "A"} and m.ambiguous == ["g"] and m.unused == ["B", "rest"] and len(m.warnings()) == 3
    with pytest.raises(D.MappingError, match="Sub-Domain"):
        D.bind_columns(D.TEMPLATE, ["Field Name", "Term Name", "Field Label"])
    with pytest.raises(D.MappingError):
        D.bind_columns([], [])


def test_workbook_values(tmp_path):
    path = write_xlsx(tmp_path / "v.xlsx", {"s": [["h", 1, 2.5, True, None, " x "]]})
    assert list(workbook_rows(open(path, "rb").read())) == [["h", 1, 2.5, True, None, " x "][:6]]


def dated_xlsx(path, cells, codes, since_1904=False):
    """A workbook whose one row has (serial or ISO text, style) cells; styles have built-in format numbers or codes of their own."""
    path = write_xlsx(path, {"s": [["seen"]]})
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    own = {c: 164 + i for i, c in enumerate(x for x in codes if isinstance(x, str))}
    formats = "".join(f'<numFmt numFmtId="{n}" formatCode="{escape(c, {chr(34): "&quot;"})}"/>' for c, n in own.items())
    xfs = "".join(f'<xf numFmtId="{own.get(c, c)}"/>' for c in codes)
    row = "".join(f'<c t="d"><v>{v}</v></c>' if isinstance(v, str) else f'<c s="{k}"><v>{v!r}</v></c>' for v, k in cells)
    with zipfile.ZipFile(path) as z:
        parts = {n: z.read(n).decode() for n in z.namelist()}
    parts["xl/worksheets/sheet1.xml"] = parts["xl/worksheets/sheet1.xml"].replace("</sheetData>", f'<row r="2">{row}</row></sheetData>')
    parts["xl/styles.xml"] = f"<styleSheet {main}><numFmts>{formats}</numFmts><cellStyleXfs><xf numFmtId=\"14\"/></cellStyleXfs><cellXfs>{xfs}</cellXfs></styleSheet>"
    if since_1904:
        parts["xl/workbook.xml"] = parts["xl/workbook.xml"].replace("<sheets>", '<workbookPr date1904="1"/><sheets>')
    with zipfile.ZipFile(path, "w") as z:
        for n, x in parts.items():
            z.writestr(n, x)
    return path


CODES = [0, 14, 46, "yyyy-mm-dd hh:mm", '0.0" days"', "[h]:mm", "[Red]0.00", '#,##0\\d', "hh:mm;@"]


def test_dates_of_workbooks(tmp_path):
    cells = [(45000, 0), (45000, 1), (45000.75, 3), (1, 1), (59, 1), (61, 1), (0.5, 8), (1.25, 2), (1.5, 5), (2.5, 4), (3.5, 6), (7, 7), (10**9, 1), ("2024-03-01", 0), ("2024-03-01T10:00:00", 0), ("soon", 0)]
    got = list(workbook_rows(open(dated_xlsx(tmp_path / "d.xlsx", cells, CODES), "rb").read()))[1]
    at = datetime.datetime
    assert got == [
        45000, at(2023, 3, 15), at(2023, 3, 15, 18), at(1900, 1, 1), at(1900, 2, 28), at(1900, 3, 1), datetime.time(12), datetime.timedelta(days=1, hours=6), datetime.timedelta(days=1, hours=12),
        2.5, 3.5, 7, "#VALUE!", datetime.date(2024, 3, 1), at(2024, 3, 1, 10), "soon",
    ]
    later = list(workbook_rows(open(dated_xlsx(tmp_path / "e.xlsx", [(0, 1), (1, 1), (43538.5, 3)], CODES, since_1904=True), "rb").read()))[1]
    assert later == [datetime.time(0), at(1904, 1, 2), at(2023, 3, 15, 12)]


def test_date_cells_are_text_of_their_own_type(spark, tmp_path):
    path = dated_xlsx(tmp_path / "d.xlsx", [(45000.5, 1), (0.25, 8), (2, 0)], CODES)
    row = [r for r in sheet_rows(spark, path).collect() if r.row_number == 2][0]
    assert row.cells == ["2023-03-15 12:00:00", "06:00:00", "2"] and row.types == ["datetime", "time", "int"]


@pytest.mark.parametrize(
    ("guidance", "values", "unit"),
    [
        ("e.g. Red, Green; Blue / Red", ["Red", "Green", "Blue"], None),
        ("A / a", ["A", "a"], None),
        ("no marker, here", [], None),
        ("E.g x", ["x"], None),
        ("in kWh", [], "kW"),
        ("commissioning", [], "mm"),
        ("from x", [], "m"),
        ("e.g. " + ",".join(map(str, range(21))), [], None),
        (None, [], None),
        ("  ", [], None),
    ],
)
def test_guidance_rules(spark, guidance, values, unit):
    g = F.lit(guidance).cast("string")
    got = spark.range(1).select(T.accepted_values(g).alias("v"), T.unit(g).alias("u")).first()
    assert (got.v, got.u) == (values, unit)


@pytest.mark.parametrize(
    ("label", "definition", "notes", "kind"),
    [("x", "Y / N", None, "boolean"), ("Update", "", "", "date"), ("x", "the date", "", "string"), ("Count", "", "", "integer"), ("x", "operating", "", "decimal"), ("x", "", "class", "enum"), ("", "", None, "unknown"), ("x", "", "", "string")],
)
def test_types(spark, label, definition, notes, kind):
    assert spark.range(1).select(T.expected_type(F.lit(label), F.lit(definition), F.lit(notes).cast("string")).alias("t")).first().t == kind


def test_clean_cells_and_headers(spark):
    cells = spark.createDataFrame([(1, " a \t b\n"), (2, " \x1c "), (3, None), (4, " x ")], "i int, v string")
    assert {r.i: r.c for r in cells.select("i", T.clean_cell(F.col("v")).alias("c")).collect()} == {1: "a b", 2: None, 3: None, 4: "x"}
    h = spark.createDataFrame([(1, "A"), (2, " "), (3, "A "), (4, None)], "pos int, header string")
    assert {r.pos: r.name for r in D.unique_headers(h).collect()} == {1: "A", 2: "blank_column_2", 3: "A__2", 4: "blank_column_4"}


def test_order_of_input_does_not_matter(spark, book):
    r = dictionaries.ingest_dictionary(spark, book)
    again = D.normalize_rows(r.rows.repartition(7), r.mapping, "Extraction Template", "dict.xlsx")
    key = lambda df: sorted(map(str, df.collect()))
    assert key(again) == key(r.results)


def _held(folder):
    return {str(p.relative_to(folder)): p.read_bytes() for p in sorted(folder.rglob("*")) if p.is_file()}


@pytest.mark.parametrize("single", [True, False])
def test_artifacts_appear_together(spark, book, tmp_path, monkeypatch, single):
    """A task whose worker dies leaves the earlier set whole; a writer that ends amid its moves is followed up by ``settle``."""
    out = tmp_path / "out"
    result = dictionaries.ingest_dictionary(spark, book)
    sinks.write_dictionary(result, str(out), single)
    before = _held(out)

    @F.udf("string")
    def dies(x):
        os._exit(1)

    class Poisoned(dictionaries.DictionaryResult):
        issues = property(lambda self: D.issue_rows(self.results).withColumn("message", dies("message")))

    with pytest.raises(Exception):  # noqa: B017 - Spark's error for a lost worker
        sinks.write_dictionary(Poisoned(**vars(result)), str(out), single)
    assert _held(out) == before

    real, moves = sinks.filesystem, []

    class Stops:
        def __init__(self, where):
            self.where = where

        def __getattr__(self, name):
            return getattr(self.where, name)

        def move(self, a, b):
            if "/_staged-" in a and not a.endswith(".json") and "/part-" not in a and b.startswith(f"{out}/") and "/_staged-" not in b:
                moves.append(b)
                if len(moves) == 3:
                    raise OSError("the driver is gone")
            self.where.move(a, b)

    fewer = dataclasses.replace(result, results=result.results.where(D.NORMALIZED).limit(1))
    monkeypatch.setattr(sinks, "filesystem", lambda uri: (Stops(real(uri)[0]), real(uri)[1]))
    with pytest.raises(OSError, match="the driver is gone"):
        sinks.write_dictionary(fewer, str(out), single)
    assert (out / sinks.JOURNAL).exists()
    monkeypatch.setattr(sinks, "filesystem", real)
    sinks.settle(str(out))
    assert {p.name for p in out.iterdir() if not p.name.startswith(".")} == set(sinks.DICTIONARY_ARTIFACTS.values())
    target = out / "normalized_targets.jsonl"
    assert sum(len(p.read_text().splitlines()) for p in ([target] if single else target.glob("part-*"))) == 1
