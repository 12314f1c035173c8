"""Members of ZIP archives: entries are listed first, and only those that passed all checks are inflated, one by one, up to the sizes that they declare.

Archives of any size are read where they lie: one task lists the central directory, which tells where each member's bytes are; members are then dealt out by byte ranges of their archive, so
that many tasks inflate one large archive, each seeking to its members without reading the directory again. Only members of archives, whose size is bounded, are opened from their bytes.
"""

from __future__ import annotations

import contextlib
import io
import itertools
import time
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packloom.operators.members import ArchiveLimits
from packloom.sources.pack_files import scan
from packloom.sources.shared import filesystem

LISTED = (
    "archive string, archive_path string, archive_depth int, entries int, corrupt string, idx int, member_path string, is_dir boolean, "
    "encrypted boolean, compressed_size bigint, uncompressed_size bigint, crc bigint, header_offset bigint, method int, stored_name string, duration_ms double"
)
#: Where a member's bytes are and how they are packed.
PLACE = ("header_offset", "method", "stored_name", "compressed_size", "uncompressed_size", "crc")
EXTRACTED = (
    "archive string, archive_path string, archive_depth int, idx int, member_path string, size_bytes bigint, sha256 string, head binary, pdf_markers bigint, "
    "content binary, failure string, duration_ms double"
)
BATCH_BYTES = 16 << 20
#: Bytes of an archive whose members go to one task together, and of packed bytes read at once.
DEAL_BYTES, PACKED = 4 << 20, 1 << 16
_TYPES = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "double": pa.float64()}
_BROKEN = (zipfile.BadZipFile, OSError, ValueError)
_UNREADABLE = (OSError, zipfile.BadZipFile, zlib.error, RuntimeError, ValueError, NotImplementedError, EOFError)


def _schema(text: str) -> pa.Schema:
    return pa.schema([(x.split()[0], _TYPES[x.split()[1]]) for x in text.split(", ")])


def open_source(path: str, content: bytes | None):
    """A seekable stream: over the bytes if there are some, else over the file."""
    if content is not None:
        return io.BytesIO(content)
    where, name = filesystem(path)
    return where.open_input_file(name)


def _listed(path: str, content: bytes | None, most: int) -> Iterator[dict]:
    start = time.perf_counter()
    try:
        with open_source(path, content) as stream, zipfile.ZipFile(stream) as z:
            infos = z.infolist()
    except _BROKEN as e:
        yield {"entries": 0, "corrupt": str(e)[:200], "duration_ms": (time.perf_counter() - start) * 1000}
        return
    yield {"entries": len(infos), "duration_ms": (time.perf_counter() - start) * 1000}
    for i, info in enumerate(infos[:most]):
        yield {"idx": i, "member_path": info.filename.replace("\\", "/"), "is_dir": info.is_dir(), "encrypted": bool(info.flag_bits & 1), "compressed_size": info.compress_size, "uncompressed_size": info.file_size, "crc": info.CRC, "header_offset": info.header_offset, "method": info.compress_type, "stored_name": info.orig_filename}


def _opened_later(name: str):
    """Whether a member's bytes are needed again, by its head: archives, workbooks and CSV files are."""
    return lambda head: head[:4] == b"PK\3\4" or name.lower().endswith((".zip", ".csv"))


class Member:
    """The bytes of a stored or deflated member at its place in a stream, as they are read; BadZipFile if its header or its checksum isn't what the directory says."""

    def __init__(self, stream, w: dict):
        stream.seek(w["header_offset"])
        head = stream.read(30)
        if len(head) < 30 or head[:4] != b"PK\3\4":
            raise zipfile.BadZipFile("no member's header where the directory says")
        flags, name, extra = int.from_bytes(head[6:8], "little"), int.from_bytes(head[26:28], "little"), int.from_bytes(head[28:30], "little")
        if stream.read(name).decode("utf-8" if flags & 0x800 else "cp437") != w["stored_name"]:
            raise zipfile.BadZipFile("the member's name isn't the one in the directory")
        stream.seek(w["header_offset"] + 30 + name + extra)
        self.stream, self.packed, self.left, self.crc, self.wanted = stream, w["compressed_size"], w["uncompressed_size"], 0, w["crc"]
        self.inflate = zlib.decompressobj(-15) if w["method"] == zipfile.ZIP_DEFLATED else None

    def _packed(self, n: int) -> bytes:
        data = self.stream.read(min(n, self.packed))
        self.packed -= len(data)
        return data

    def read(self, n: int) -> bytes:
        n, data = min(n, self.left), b""
        while n and not data:
            if self.inflate is None:
                data = self._packed(n)
                if not data:
                    break
            else:
                more = self.inflate.unconsumed_tail or self._packed(PACKED)
                data = self.inflate.decompress(more, n)
                if not more and not data:
                    break
        self.crc, self.left = zlib.crc32(data, self.crc), self.left - len(data)
        if self.left == 0 and self.crc != self.wanted:
            raise zipfile.BadZipFile("the member's bytes fail their CRC-32")
        return data


def _ranged(path: str, wanted: list[dict]) -> Iterator[dict]:
    """Members of one archive file, in the order of their places."""
    keep = ("archive", "archive_path", "archive_depth", "idx", "member_path")
    with contextlib.ExitStack() as stack:
        stream = whole = None
        for w in wanted:
            start = time.perf_counter()
            try:
                if stream is None:
                    stream = stack.enter_context(open_source(path, None))
                if w["method"] in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
                    found = _member(Member(stream, w), w["member_path"], w["uncompressed_size"])
                else:  # of the other methods zipfile knows more
                    whole = whole or zipfile.ZipFile(stack.enter_context(open_source(path, None)))
                    with whole.open(whole.infolist()[w["idx"]]) as member:
                        found = _member(member, w["member_path"], w["uncompressed_size"])
            except _UNREADABLE as e:
                found = {"failure": str(e)[:200]}
            yield {k: w[k] for k in keep} | found | {"duration_ms": (time.perf_counter() - start) * 1000}


def _member(stream, name: str, size: int) -> dict:
    digest, n, head, markers, data = scan(stream, _opened_later(name))
    if n != size:
        raise ValueError("the member's size isn't the declared one")
    return {"size_bytes": n, "sha256": digest, "head": head, "pdf_markers": markers, "content": data}


def _extracted(path: str, content: bytes | None, wanted: list[dict]) -> Iterator[dict]:
    try:
        with open_source(path, content) as stream, zipfile.ZipFile(stream) as z:
            infos = z.infolist()
            for w in sorted(wanted, key=lambda w: w["idx"]):
                start, info = time.perf_counter(), infos[w["idx"]]
                try:
                    with z.open(info) as member:
                        found = _member(member, w["member_path"], info.file_size)
                except _UNREADABLE as e:
                    found = {"failure": str(e)[:200]}
                yield w | found | {"duration_ms": (time.perf_counter() - start) * 1000}
    except _BROKEN as e:  # it could be read when it was listed
        for w in wanted:
            yield w | {"failure": str(e)[:200]}


def _batched(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r.get("content") or b"") + 256
        if size > BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def list_archives(archives: DataFrame, limits: ArchiveLimits = ArchiveLimits()) -> DataFrame:
    """(source_id, original_path, logical_path, archive_depth, content) rows to one row an archive (idx null) and one row an entry. Null content: the file at original_path."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                of = {"archive": r["source_id"], "archive_path": r["logical_path"], "archive_depth": r["archive_depth"]}
                yield from _batched((of | e for e in _listed(r["original_path"], r["content"], limits.max_member_count)), _schema(LISTED))

    return archives.select("source_id", "original_path", "logical_path", "archive_depth", "content").mapInArrow(expand, LISTED)


def extract_members(archives: DataFrame, accepted: DataFrame) -> DataFrame:
    """What the ``accepted`` entries (archive, idx, member_path and ``PLACE``) of ``archives`` hold: size, hash, head, page markers, the bytes of those that are opened later, or why they can't be read.

    Members of archive files are dealt out by byte ranges of ``DEAL_BYTES``; those of an archive that is held as bytes are read in one task.
    """
    spark = archives.sparkSession
    of = [F.col("source_id").alias("archive"), "original_path", F.col("logical_path").alias("archive_path"), "archive_depth"]

    def by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in batch.to_pylist())
        for path, wanted in itertools.groupby(rows, key=lambda r: r["original_path"]):
            yield from _batched(_ranged(path, wanted), _schema(EXTRACTED))

    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lying = archives.where("content IS NULL").select(*of).join(accepted.select("archive", "idx", "member_path", *PLACE), "archive")
    lying = lying.repartition(tasks, "archive", F.expr(f"header_offset DIV {DEAL_BYTES}")).sortWithinPartitions("original_path", "header_offset")
    ranged = lying.mapInArrow(by_range, EXTRACTED)

    wanted = accepted.groupBy(F.col("archive").alias("source_id")).agg(F.collect_list(F.struct("idx", "member_path")).alias("wanted"))

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                of = {"archive": r["source_id"], "archive_path": r["logical_path"], "archive_depth": r["archive_depth"]}
                yield from _batched((of | e for e in _extracted(r["original_path"], r["content"], r["wanted"])), _schema(EXTRACTED))

    held = archives.where("content IS NOT NULL").join(wanted, "source_id")
    held = held.select("source_id", "original_path", "logical_path", "archive_depth", "content", "wanted").mapInArrow(expand, EXTRACTED)
    return ranged.unionByName(held)
