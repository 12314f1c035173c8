"""Test data for the catalog beside its views: packs and dictionary files made of the tables, for queries over what the engine reads and writes. Tasks write the files into the shared folder."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packloom.plans import views as V
from packloom.ship import ship
from packloom.sources.shared import filesystem

#: File names of documents by doc_id, how such a file begins, and the type that it has.
SUFFIXES = (".txt", ".pdf", ".csv", ".json", ".md", ".log", ".zip")
HEADS = ("", "%PDF-1.4 /Type /Page ", "", "", "", "", "")
KINDS = ("text", "pdf", "csv", "json", "text", "text", "zip")
#: Documents of an archive, fewer than an archive may have members.
ARCHIVE_DOCS = 400


def write_files(rows: DataFrame, folder: str) -> None:
    """Each row (name, content) as a file below ``folder``."""
    ship(rows.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, base = filesystem(folder)
        made: set[str] = set()
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content").to_pylist()):
                path = f"{base}/{name}"
                parent = path.rsplit("/", 1)[0]
                if parent not in made:
                    where.create_dir(parent, recursive=True)
                    made.add(parent)
                with where.open_output_stream(path, compression=None) as out:
                    out.write(content or b"")
            yield batch.select(["name"])

    rows.select("name", F.col("content").cast("binary").alias("content")).mapInArrow(write, "name string").count()


def document_files(spark: SparkSession, d: str) -> DataFrame:
    """Documents as files: name and content. Some are lock files, which are ignored."""
    t, i = V.table(spark, d, "documents").select("doc_id", "text", "lang"), F.col("doc_id")
    name = F.concat(F.coalesce("lang", F.lit("none")), F.lit("/"), F.when(i % 23 == 0, "~$").otherwise(""), F.lit("plan "), i, V._pick(SUFFIXES, i))
    return t.select("doc_id", name.alias("name"), F.concat(V._pick(HEADS, i), F.coalesce("text", F.lit(""))).alias("content"))


DOCUMENT_FILES = f"""file0 AS (SELECT doc_id, coalesce(lang, 'none') || '/' || CASE WHEN doc_id % 23 = 0 THEN '~$' ELSE '' END || 'plan ' || doc_id || {V._pick_sql(SUFFIXES, 'doc_id')} AS logical_path,
  {V._pick_sql(HEADS, 'doc_id')} || coalesce(text, '') AS content, {V._pick_sql(SUFFIXES, 'doc_id')} AS extension, {V._pick_sql(KINDS, 'doc_id')} AS file_type, doc_id % 23 = 0 AS ignored FROM documents),
file AS (SELECT *, sha256(content) AS file_hash, strlen(content) AS size_bytes, 'src_' || substr(sha256(sha256(content) || '|' || logical_path || '||'), 1, 16) AS source_id FROM file0)"""


def write_document_pack(spark: SparkSession, d: str, folder: str) -> None:
    write_files(document_files(spark, d), folder)


def _zipped(entries: list[tuple[str, bytes]]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name, content in entries:
            z.writestr(zipfile.ZipInfo(name), content)
    return out.getvalue()


def write_archive_pack(spark: SparkSession, d: str, folder: str) -> None:
    """Documents as members of archives of ``ARCHIVE_DOCS`` doc_ids each; some members have absolute paths, and the first archive lies in another."""
    t, i = V.table(spark, d, "documents").select("doc_id", "text"), F.col("doc_id")
    path = F.concat(F.when(i % 19 == 0, "/").otherwise(""), F.lit("m/"), i, F.lit(".txt"))
    rows = t.select(F.expr(f"doc_id DIV {ARCHIVE_DOCS}").alias("archive"), i.alias("k"), path.alias("path"), F.coalesce("text", F.lit("")).cast("binary").alias("content"))
    ship(spark)

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        archive, rows = key[0].as_py(), rows.sort_by("k")
        data = _zipped(list(zip(rows.column("path").to_pylist(), rows.column("content").to_pylist())))
        data = _zipped([("in/0.zip", data)]) if archive == 0 else data
        return pa.table({"name": [f"a{archive}.zip"], "content": pa.array([data], pa.binary())})

    write_files(rows.groupBy("archive").applyInArrow(pack, "name string, content binary"), folder)


#: The members of those archives, stored with 76 bytes and twice their name each, and 22 bytes an archive.
ARCHIVE_MEMBERS = f"""member0 AS (SELECT doc_id, doc_id // {ARCHIVE_DOCS} AS a, CASE WHEN doc_id % 19 = 0 THEN '/' ELSE '' END || 'm/' || doc_id || '.txt' AS path, coalesce(text, '') AS content FROM documents),
member AS (SELECT *, CASE WHEN a = 0 THEN 'a0.zip!/in/0.zip' ELSE 'a' || a || '.zip' END AS archive_path, strlen(content) AS size, doc_id % 19 <> 0 AS good FROM member0),
inner_zip AS (SELECT CAST(22 + sum(76 + 2 * strlen(path) + size) AS BIGINT) AS size FROM member WHERE a = 0 HAVING count(*) > 0)"""


#: Rows of a part of a written dictionary, and the bytes of the ranges in which queries read it: some ranges a part.
PART_ROWS, RANGE_BYTES = 20_000, 1 << 16


def write_dictionary_csv(spark: SparkSession, d: str, path: str) -> None:
    """Parts as a CSV dictionary: a folder of part files, each written by a task. Some cells span lines."""
    order = V.DICTIONARY_COLUMNS
    rows = V.dictionary(spark, d)
    cells = [F.coalesce(F.try_element_at("cells", F.lit(c)), F.lit("")) for c in order]
    cells = [F.when(F.col("row_number") % 3 == 0, F.concat(c, F.lit("\r\n"))).otherwise(c) for c in cells]  # goes when cells are cleaned
    quoted = [F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')) for c in cells]
    head = spark.range(1).select(F.lit(-(2**31)).alias("row_number"), F.lit(",".join(f'"{c}"' for c in order)).alias("line"))
    lines = head.unionByName(rows.select("row_number", F.concat_ws(",", *quoted).alias("line")))
    parts = 1 + rows.count() // PART_ROWS
    lines.repartitionByRange(parts, "row_number").sortWithinPartitions("row_number").select("line").write.text(path)


def write_dictionary_xlsx(spark: SparkSession, d: str, path: str, sheet: str) -> None:
    """The same as a workbook of one sheet with inline strings, which one task writes as the rows come."""
    order = V.DICTIONARY_COLUMNS
    ship(spark)
    rows = V.dictionary(spark, d).select("row_number", F.array(*[F.try_element_at("cells", F.lit(c)) for c in order]).alias("cells"))

    def book(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
        rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
        row = lambda n, cells: f'<row r="{n}">' + "".join(f'<c r="{chr(65 + i)}{n}" t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>' for i, v in enumerate(cells) if v is not None) + "</row>"
        where, name = filesystem(path)
        where.create_dir(name.rsplit("/", 1)[0], recursive=True)
        with where.open_output_stream(name, compression=None) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("xl/workbook.xml", f'<workbook {main} {rel}><sheets><sheet name="{sheet}" sheetId="1" r:id="rId1"/></sheets></workbook>')
            z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
            with z.open("xl/worksheets/sheet1.xml", "w") as part:
                part.write(f"<worksheet {main}><sheetData>{row(1, order)}".encode())
                for batch in batches:
                    part.write("".join(row(n + 1, cells) for n, cells in zip(batch.column("row_number").to_pylist(), batch.column("cells").to_pylist())).encode())
                part.write(b"</sheetData></worksheet>")
        yield pa.RecordBatch.from_arrays([pa.array([path])], names=["name"])

    rows.repartition(1).sortWithinPartitions("row_number").mapInArrow(book, "name string").count()
