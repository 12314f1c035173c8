import csv
import hashlib
import io
import json
import os
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from packloom.operators.members import ArchiveLimits
from packloom.operators.timings import PACK_STAGES, to_stderr
from packloom.plans import dictionaries, pack, sinks
from packloom.sources import archives, pack_files
from packloom.sources.pack_files import BLOCK, scan
from test_dictionary import ORDER, ROWS, write_xlsx


def zipped(entries):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in entries:
            z.writestr(name, data)
    return out.getvalue()


PDF = b"%PDF-1.4\n/Type /Page\n"
SURVEY = b"one survey, kept under two names"


@pytest.fixture()
def tree(tmp_path):
    root = tmp_path / "pack"
    (root / "level2").mkdir(parents=True)
    inner = zipped([("leaf.txt", b"deep")])
    content = {
        "north.txt": SURVEY,
        "south.txt": SURVEY,
        "plan.pdf": PDF,
        "level2/plan.pdf": PDF + b"changed\n",
        "boiler-manual.pdf": b"%PDF-1.4\n/Type /Page\n/Type /Page\n",
        "level2/lamps.csv": b"kind,number\nlamp,7\n",
        "Thumbs.db": b"ignored",
        ".dotted": b"text",
        "_low.txt": b"text too",
        "nothing": b"",
        "torn.zip": b"no archive at all",
        "scan.bin": PDF,
        "handover.zip": zipped([("docs/pump-manual.pdf", PDF), ("more/second.zip", inner), ("../out.txt", b"x"), ("/top.txt", b"x"), ("dir/", b""), ("docs/pump-manual.pdf", b"again"), ("zeros.txt", b"\0" * 100_000)]),
        "edge.txt": b"a" * 511 + "é".encode(),
    }
    for name, data in content.items():
        (root / name).write_bytes(data)
    write_xlsx(root / "yearly.xlsx", {"Lifts": [["a"]], "Maintenance": [["b"]]})
    return root, content


def test_ingest(spark, tree, tmp_path):
    root, content = tree
    r = pack.ingest_source_pack(spark, str(root))
    found = {x.relative_path: x for x in r.discovered.collect()}
    assert set(found) == {*content, "yearly.xlsx"}
    assert found["Thumbs.db"].disposition == "ignored" and found["nothing"].disposition == "registered_with_warnings"
    kinds = {k: v.detected_type for k, v in found.items()}
    assert (kinds["scan.bin"], kinds["handover.zip"], kinds["yearly.xlsx"], kinds[".dotted"], kinds["nothing"], kinds["edge.txt"], kinds["level2/lamps.csv"]) == ("pdf", "zip", "xlsx", "text", "unknown", "text", "csv")
    reg = {x.logical_path: x for x in r.registry.collect()}
    assert "Thumbs.db" not in reg and reg["north.txt"].file_hash == hashlib.sha256(SURVEY).hexdigest()
    made = lambda path: "src_" + hashlib.sha256(f"{hashlib.sha256(SURVEY).hexdigest()}|{path}||".encode()).hexdigest()[:16]
    assert (reg["north.txt"].source_id, reg["south.txt"].source_id) == (made("north.txt"), made("south.txt"))
    assert reg["boiler-manual.pdf"].page_count == 2 and reg["yearly.xlsx"].sheet_count == 2 and reg["level2/lamps.csv"].metadata["columns"] == "kind|number"
    label = {k: v.classification for k, v in reg.items()}
    assert (label["boiler-manual.pdf"], label["yearly.xlsx"], label["level2/lamps.csv"], label["north.txt"], label["handover.zip"]) == ("building manual", "maintenance schedule", "spreadsheet", "unknown", "archive")
    assert {"handover.zip!/docs/pump-manual.pdf", "handover.zip!/more/second.zip", "handover.zip!/more/second.zip!/leaf.txt"} <= set(reg)
    assert reg["handover.zip!/more/second.zip!/leaf.txt"].archive_depth == 2
    arch = {x.archive_path: x for x in r.archives.collect()}
    assert arch["torn.zip"].issues == ["CORRUPT_ARCHIVE"] and arch["handover.zip"].member_count == 7
    got = {(x.archive_path, x.idx): (x.status, x.issues) for x in r.members.collect()}
    assert got["handover.zip", 0] == ("registered", []) and got["handover.zip", 2] == ("rejected", ["ARCHIVE_PATH_TRAVERSAL"]) and got["handover.zip", 3] == ("rejected", ["ARCHIVE_ABSOLUTE_PATH"])
    assert got["handover.zip", 4] == ("ignored", []) and got["handover.zip", 5] == ("rejected", ["ARCHIVE_DUPLICATE_MEMBER"]) and got["handover.zip", 6] == ("rejected", ["ARCHIVE_COMPRESSION_RATIO_LIMIT"])
    groups = {(x.duplicate_type, x.group_id) for x in r.duplicates.collect()}
    assert ("same_content_different_filenames", "dup_" + hashlib.sha256("|".join(["same_content_different_filenames", made("north.txt"), made("south.txt")]).encode()).hexdigest()[:16]) in groups
    same = [x for x in r.duplicates.collect() if x.content_hash == hashlib.sha256(SURVEY).hexdigest()][0]
    assert same.duplicate_type == "same_content_different_filenames" and same.source_ids == [made("north.txt"), made("south.txt")] and same.recommended_canonical_source_id == same.source_ids[0]
    assert any(t == "same_filename_different_content" for t, _ in groups)
    s = r.summary.first()
    assert (s.files_discovered, s.files_ignored, s.files_rejected) == (15, 1, 0) and s.warnings_by_code["CORRUPT_ARCHIVE"] == 1 and s.classification_counts["archive"] >= 2
    paths = sinks.write_pack(r, str(tmp_path / "out"), single_file=True)
    times = json.load(open(paths["stage_timings"]))
    assert set(times) == set(PACK_STAGES) and times["discovery_ms"] > 0 and times["artifact_writing_ms"] > 0
    manifest = json.load(open(paths["source_pack_manifest"]))
    assert manifest["source_pack_id"] == "sp_" + hashlib.sha256(str(root.resolve()).casefold().encode()).hexdigest()[:16] and manifest["output_paths"] == paths
    by_file = {x["relative_path"]: x for x in csv.DictReader(open(paths["file_timings_csv"]))}
    assert set(by_file) == set(found) and by_file["Thumbs.db"]["status"] == "ignored" and float(by_file["handover.zip"]["archive_duration_ms"]) > 0 and float(by_file["boiler-manual.pdf"]["total_duration_ms"]) > 0
    issues = list(csv.DictReader(open(paths["ingestion_issues_csv"])))
    assert list(issues[0]) == ["issue_code", "severity", "source_path", "archive_member_path", "message", "raw_value", "suggested_action"] and all(x["severity"] and x["message"] and x["suggested_action"] for x in issues)
    ranks = [0 if x["issue_code"] == "UNSUPPORTED_FILE_TYPE" else 1 if x["issue_code"] == "CORRUPT_ARCHIVE" else 2 for x in issues]
    assert ranks == sorted(ranks)
    kinds = [json.loads(x)["duplicate_type"] for x in open(paths["duplicate_groups"])]
    assert kinds[-1] == "same_filename_different_content" and kinds[0] in ("identical_content", "same_content_different_filenames")
    assert len(paths) == 11 and len(open(paths["source_registry_jsonl"]).read().splitlines()) == len(reg)
    assert json.load(open(paths["source_summary"]))["files_discovered"] == 15
    again = {x.logical_path: x.source_id for x in pack.ingest_source_pack(spark, str(root)).registry.collect()}
    assert again == {k: v.source_id for k, v in reg.items()}


def test_limits(spark, tree):
    root, _ = tree
    none = pack.ingest_source_pack(spark, str(root), ArchiveLimits(max_depth=0))
    assert none.registry.where("archive_depth > 0").count() == 0 and none.members.count() == 7
    few = pack.ingest_source_pack(spark, str(root), ArchiveLimits(max_member_count=1, max_member_bytes=10))
    assert {x.archive_path: x.issues for x in few.archives.collect()}["handover.zip"] == ["ARCHIVE_MEMBER_LIMIT"]
    assert [x.issues for x in few.members.where("archive_path = 'handover.zip'").collect()] == [["ARCHIVE_MEMBER_SIZE_LIMIT"]]


def test_inspect(spark, tree):
    root, _ = tree
    got = pack.inspect_source_pack(spark, str(root))
    assert {r.extension: r.n for r in got["extensions"].collect()}[".pdf"] == 3
    assert [r.name for r in got["duplicate_names"].collect()] == ["plan.pdf"]
    assert sorted(r.relative_path for r in got["zip_archives"].collect()) == ["handover.zip", "torn.zip"]
    assert [r.relative_path for r in got["unsupported_files"].collect()] == ["nothing"]


def test_archives_of_any_size(spark, tmp_path):
    """An archive larger than what is held at once, opened where it lies; what the checks reject isn't read and adds nothing to the sum."""
    root = tmp_path / "big"
    root.mkdir()
    noise = random.Random(1).randbytes(1 << 20)
    with zipfile.ZipFile(root / "large.zip", "w", zipfile.ZIP_STORED) as z:
        for i in range(140):
            z.writestr(f"part{i:03}.bin", noise)
    (root / "sum.zip").write_bytes(zipped([("/top.txt", b"a" * 80), ("ok.txt", b"b" * 80), ("over.txt", b"c" * 30), ("small.txt", b"d" * 20)]))
    (root / "broken.zip").write_bytes(zipped([("one.txt", b"1" * 50), ("two.txt", b"2" * 50)]).replace(b"1" * 10, b"x" * 10))
    with zipfile.ZipFile(root / "broken.zip", "w", zipfile.ZIP_STORED) as z:
        z.writestr("one.txt", b"1" * 50)
        z.writestr("two.txt", b"2" * 40)
    data = (root / "broken.zip").read_bytes()
    (root / "broken.zip").write_bytes(data.replace(b"1" * 50, b"9" * 50, 1))
    r = pack.ingest_source_pack(spark, str(root), ArchiveLimits(max_depth=1))
    got = {x.archive_path: x for x in r.archives.collect()}
    assert (got["large.zip"].member_count, got["large.zip"].extracted_count, got["large.zip"].corrupt, got["large.zip"].total_uncompressed_bytes) == (140, 140, None, 140 << 20)
    assert r.registry.where("archive_depth = 1 AND logical_path LIKE 'large%'").select("file_hash").distinct().collect()[0][0] == hashlib.sha256(noise).hexdigest()
    assert (got["broken.zip"].extracted_count, got["broken.zip"].rejected_count, got["broken.zip"].total_uncompressed_bytes) == (1, 1, 90)
    failed = r.issues.where("issue_code = 'ARCHIVE_EXTRACTION_FAILED'").collect()
    assert [(x.archive_member_path, x.severity) for x in failed] == [("one.txt", "error")] and "CRC" in failed[0].raw_value
    r.release()
    few = pack.ingest_source_pack(spark, str(root), ArchiveLimits(max_uncompressed_bytes=100))
    status = {x.member_path: (x.status, x.issues) for x in few.members.where("archive_path = 'sum.zip'").collect()}
    assert status == {"/top.txt": ("rejected", ["ARCHIVE_ABSOLUTE_PATH"]), "ok.txt": ("registered", []), "over.txt": ("rejected", ["ARCHIVE_UNCOMPRESSED_LIMIT"]), "small.txt": ("registered", [])}
    assert {x.archive_path: x for x in few.archives.collect()}["sum.zip"].total_uncompressed_bytes == 100
    few.release()


def test_unreadable_files(spark, tmp_path, monkeypatch):
    root = tmp_path / "some"
    root.mkdir()
    (root / "good.txt").write_text("x")
    os.symlink("/proc/self/mem", root / "bad.txt")  # opens, but can't be read from its start
    r = pack.ingest_source_pack(spark, str(root))
    got = {x.relative_path: x.disposition for x in r.discovered.collect()}
    assert got == {"good.txt": "registered", "bad.txt": "rejected"} and [x.logical_path for x in r.registry.collect()] == ["good.txt"]
    assert [(x.issue_code, x.source_path) for x in r.issues.orderBy("place").collect()] == [("SOURCE_REGISTRATION_FAILED", "bad.txt"), ("UNREADABLE_FILE", "bad.txt")]
    assert r.summary.first().files_rejected == 1
    with pytest.raises(OSError, match="bad.txt"):
        pack.ingest_source_pack(spark, str(root), fail_on_unreadable=True)


def test_roots_may_be_uris(spark, tmp_path):
    """Names aren't escaped: spaces, signs and percent signs stay as they are."""
    root = tmp_path / "a b"
    root.mkdir()
    (root / "x #1 50%20.csv").write_bytes(b"one,two\n1,2\n")
    (root / "y z.zip").write_bytes(zipped([("in side.txt", b"deep")]))
    for place in (str(root), f"file://{root}", f"{root}/"):
        r = pack.ingest_source_pack(spark, place)
        got = {x.logical_path: (x.metadata or {}).get("columns") for x in r.registry.collect()}
        assert got == {"x #1 50%20.csv": "one|two", "y z.zip": None, "y z.zip!/in side.txt": None}
        r.release()
    paths = sinks.write_dictionary(dictionaries.ingest_dictionary(spark, f"file://{write_xlsx(root / 'd.xlsx', {'s': [ORDER, ROWS[0]]})}"), f"file://{root}/out", single_file=True)
    assert open(paths["normalized_targets_csv"].removeprefix("file://")).readline().startswith("target_row_id")


def test_progress(spark, tree, capsys):
    root, _ = tree
    told = []
    pack.ingest_source_pack(spark, str(root), ArchiveLimits(max_depth=0), progress=lambda *x: told.append(x)).release()
    assert [x for x, _ in told][:2] == ["discovery", "metadata"] and told[-1][0] == "duplicate_detection"
    to_stderr("stage", "subject")
    assert capsys.readouterr().err.endswith("[stage] subject\n")


def test_scan_in_blocks():
    data = b"x" * (BLOCK - 6) + b"/Type /Page" + b"y" * 100 + b"/Type/Page"
    digest, n, head, markers, content = scan(io.BytesIO(data))
    assert (digest, n, markers, content) == (hashlib.sha256(data).hexdigest(), len(data), 2, None) and head == data[:4096]
    assert scan(io.BytesIO(data), lambda head: head == data[:4096])[4] == data


def test_greedy_bound_is_not_a_running_sum(spark):
    from packloom.operators.members import check_members

    sizes = [30, 50, 20, 5, 40]
    rows = [("a", i, f"f{i}", False, False, s, s) for i, s in enumerate(sizes)]
    df = spark.createDataFrame(rows, "archive string, idx int, member_path string, is_dir boolean, encrypted boolean, compressed_size long, uncompressed_size long")
    got = {r.idx: r.status for r in check_members(df, ArchiveLimits(max_uncompressed_bytes=60)).collect()}
    assert got == {0: "registered", 1: "rejected", 2: "registered", 3: "registered", 4: "rejected"}


def test_members_of_one_archive_in_many_tasks(spark, tmp_path, monkeypatch):
    """Dealt by byte ranges, with all four methods, a member whose header is gone, one whose name differs, and one of another size."""
    monkeypatch.setattr(archives, "DEAL_BYTES", 1 << 14)
    rnd, path = random.Random(3), tmp_path / "many.zip"
    methods = (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA)
    data = {f"m/é{i}.txt" if i % 2 else f"m/{i}.csv": bytes(rnd.choices(b"abc\n", k=rnd.randrange(3000))) for i in range(600)}
    with zipfile.ZipFile(path, "w") as z:
        for i, (name, content) in enumerate(data.items()):
            z.writestr(zipfile.ZipInfo(name), content, methods[i % 4])
        offset = {x.filename: x.header_offset for x in z.infolist()}
    raw = bytearray(path.read_bytes())
    raw[offset["m/0.csv"]] = 0
    raw[offset["m/4.csv"] + 30] ^= 1
    path.write_bytes(raw)
    of = spark.createDataFrame([("s", str(path), "many.zip", 0, None)], "source_id string, original_path string, logical_path string, archive_depth int, content binary")
    limits = ArchiveLimits(max_member_count=1000)
    entries = archives.list_archives(of, limits).where("idx IS NOT NULL")
    got = archives.extract_members(of, entries)
    assert len({r.p for r in got.select(F.spark_partition_id().alias("p")).collect()}) > 8
    rows = {r.member_path: r for r in got.collect()}
    assert set(rows) == set(data) and {k for k, r in rows.items() if r.failure} == {"m/0.csv", "m/4.csv"}
    assert all(r.sha256 == hashlib.sha256(data[k]).hexdigest() and r.size_bytes == len(data[k]) and (bytes(r.content) == data[k] if k.endswith("csv") and data[k] else not r.content) for k, r in rows.items() if not r.failure)
    short = entries.withColumn("uncompressed_size", F.col("uncompressed_size") + 1)
    assert all(r.failure for r in archives.extract_members(of, short).collect())


def test_frontier_finds_every_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pack_files, "LIST_ROWS", 3)
    rnd, want = random.Random(5), {}
    for i in range(60):
        folder = tmp_path / "p" / "/".join(rnd.choices(["a", "B", ".c", "_d", "e f", "%20"], k=rnd.randrange(6)))
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{i}.txt").write_bytes(want.setdefault(str((folder / f"{i}.txt").relative_to(tmp_path / "p")), b"x" * i))
    (tmp_path / "p" / "no files").mkdir()
    for hashed in (True, False):
        found, folders = pack_files.pack_files(spark, str(tmp_path / "p") + "/", hashed)
        rows = {r.relative_path: r for r in found.collect()}
        assert set(rows) == set(want) and all(r.size_bytes == len(want[k]) and bytes(r.head) == want[k] and r.path == f"{tmp_path}/p/{k}" for k, r in rows.items())
        assert all((r.sha256 == hashlib.sha256(want[k]).hexdigest()) if hashed else r.sha256 is None for k, r in rows.items())
        assert len(folders) > 4
    (tmp_path / "none").mkdir()
    assert not pack_files.pack_files(spark, str(tmp_path / "none"))[0].count()
